"""Order MinHash fingerprints, sensitive to edit distance.

A text's elements are its k-mers (runs of K code points) with their
occurrence numbers: the third "the cat " is another element than the first.
Under each of SKETCHES hash functions the TUPLE elements of smallest hash are
selected, put back into the order in which they stand in the text, and the
tuple of them is hashed. Two texts agree in a sketch if they selected the
same elements in the same order, so moved passages count as changes, which a
plain MinHash does not see. The likeness of two texts is the share of
sketches that agree.

Each document is also compared with an edited text, its last third replaced
by the beginning of the next document, and with the next document itself. The
rows are range-partitioned by descending id once; a task streams its range
and holds two texts. The last row of a range waits for the first one of the
next range: one row per partition.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parcelkit.llm.common import prepare, row_key
from parcelkit.session import materialize

K = 8
TUPLE = 2
SKETCHES = 64
# Elements hashed at once: SKETCHES x CHUNK hashes stay in the processor's cache.
CHUNK = 2048
# Odd multipliers and offsets of the hash functions, from one seeded stream.
_RNG = np.random.default_rng(20240611)
MULTIPLIERS = _RNG.integers(0, 1 << 32, (2, SKETCHES), dtype=np.uint32) | np.uint32(1)
OFFSETS = _RNG.integers(0, 1 << 32, SKETCHES, dtype=np.uint32)
MIX = np.uint64(0x9E3779B97F4A7C15)
FINAL = np.uint64(0xBF58476D1CE4E5B9)
HIGH = np.uint64(32)


def elements(text: str, k: int = K) -> np.ndarray:
    """64-bit codes of a text's occurrence-numbered k-mers, in text order. A
    text shorter than ``k`` is one k-mer; an empty one has none."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if not len(points):
        return points
    n = max(1, len(points) - k + 1)
    code = np.full(n, k if len(points) >= k else len(points), dtype=np.uint64)
    for i in range(min(k, len(points))):
        code = (code ^ points[i:i + n]) * MIX
        code ^= code >> HIGH
    # Sorting (code, position) in one word numbers equal k-mers in text order.
    low = np.uint64(max(1, int(n - 1).bit_length()))
    mask = (np.uint64(1) << low) - np.uint64(1)
    word = np.sort((code & ~mask) | np.arange(n, dtype=np.uint64))
    at, kind = (word & mask).astype(np.int64), word >> low
    same = np.r_[False, kind[1:] == kind[:-1]]
    if same.any():
        index = np.arange(n)
        first = np.maximum.accumulate(np.where(same, 0, index))
        again = np.flatnonzero(same)
        code[at[again]] += ((index - first)[again]).astype(np.uint64) * MIX
    code = (code ^ (code >> HIGH)) * FINAL
    return code ^ (code >> HIGH)


def fingerprint(text: str | None, k: int = K) -> np.ndarray:
    """SKETCHES tuple hashes (uint16) of a whole text; null and empty texts
    have the fingerprint of zeros only."""
    code = elements(text or "", k)
    if not len(code):
        return np.zeros(SKETCHES, dtype=np.uint16)
    short = code.astype(np.uint32)  # the low half: what the hash functions take
    rows = np.arange(SKETCHES)[:, None]
    best = np.empty((SKETCHES, 0), dtype=np.uint32)
    place = np.empty((SKETCHES, 0), dtype=np.int64)
    line = np.arange(SKETCHES)
    for lo in range(0, len(short), CHUNK):
        h = (short[None, lo:lo + CHUNK] ^ OFFSETS[:, None]) * MULTIPLIERS[0][:, None]
        h ^= h >> np.uint32(15)
        h *= MULTIPLIERS[1][:, None]
        found, where = [best], [place]
        for _ in range(min(TUPLE, h.shape[1])):
            p = h.argmin(axis=1)
            found.append(h[line, p][:, None])
            where.append(p[:, None] + lo)
            h[line, p] = np.iinfo(np.uint32).max
        best, place = np.concatenate(found, axis=1), np.concatenate(where, axis=1)
        if best.shape[1] > TUPLE:
            keep = np.argsort(best, axis=1, kind="stable")[:, :TUPLE]
            best, place = best[rows, keep], place[rows, keep]
    place.sort(axis=1)
    picked = code[place]
    value = np.full(SKETCHES, len(picked[0]), dtype=np.uint64)
    for i in range(picked.shape[1]):
        value = (value ^ picked[:, i]) * MIX
        value ^= value >> HIGH
    return (value >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the sketches that agree."""
    return float((a == b).sum()) / SKETCHES


def to_text(fp: np.ndarray) -> str:
    """Four hex digits per sketch."""
    return fp.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 3) code points replaced by the first
    as many (or all) of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                     ("near_edited", pa.float64()), ("near_next", pa.float64())])
_STREAM = _RESULT.append(pa.field("part", pa.int32())).append(pa.field("edge", pa.string())).append(
    pa.field("text", pa.string()))


def _compare(doc_id, text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
    changed = edited(text, following)
    new = own if changed == text else fingerprint(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(), to_text(own),
            to_text(new), likeness(own, new), likeness(own, other))


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _stream(batches):
    """A range's rows in order: results of all rows but the last; the first
    and the last text as edges for the neighbouring ranges."""
    part = TaskContext.get().partitionId()
    held, out = None, []
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        for i, doc_id in enumerate(ids):
            text = texts[i].as_py() or ""
            own = fingerprint(text)
            if held is None:
                out.append((doc_id,) + (None,) * 6 + (part, "first", text))
            else:
                out.append(_compare(*held, text, own) + (part, None, None))
            held = (doc_id, text, own)
            if len(out) >= 1000:
                yield _batch(out, _STREAM)
                out = []
    if held is not None:
        out.append((held[0],) + (None,) * 6 + (part, "last", held[1]))
    yield _batch(out, _STREAM)


def _close(batches):
    """Results of the rows that ended a range."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            own, other = fingerprint(r["text"]), fingerprint(r["next_text"])
            out.append(_compare(r["doc_id"], r["text"], own, r["next_text"], other))
        yield _batch(out, _RESULT)


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next.

    The next document is the one that follows by descending id (null ids
    last); after the last comes the first, which may be the document itself.
    Rows of equal id follow each other by a hash of their text; repeated rows
    are documents of their own, each the next of the one before. A null text
    is empty. Empty texts are alike (1); an empty and another one are not.
    Extra columns are left out. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # The hash splits rows of one id over ranges, the row's number those of
    # one id and text, so no id or text can fill a range.
    rows = rows.withColumn("tie", row_key("text")["a"]).withColumn("number", F.monotonically_increasing_id())
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie"), F.col("number")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    done = materialize(ranged.mapInArrow(_stream, RESULT + ", part int, edge string, text string"), "editprints")
    # One first and one last row per partition; their numbers alone are ordered.
    firsts = done.where("edge = 'first'").select("part", F.col("text").alias("next_text"))
    parts = firsts.select("part")
    following = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")),
                                                F.min("part").over(Window.partitionBy())).alias("next_part"))
    lasts = done.where("edge = 'last'").select("part", "doc_id", "text")
    open_rows = (lasts.join(following, "part").join(firsts.withColumnRenamed("part", "next_part"), "next_part")
                 .select("doc_id", "text", "next_text"))
    names = [f.name for f in _RESULT]
    return done.where("edge IS NULL").select(*names).union(open_rows.mapInArrow(_close, RESULT))
