"""SimHash near-duplicates through an inverted index of byte positions.

A fingerprint is eight positional bytes. Two fingerprints at most k bits
apart differ in at most k bytes, so they share 8 - k positional bytes or
more: that is the guaranteed minimum of the count filter. A posting list per
single (position, byte) and a tally per pair would meet it too, but each of
its 2,048 lists holds 1/256 of the corpus and the tallied pairs grow with
the square of the rows. The index is therefore keyed by whole sets of 8 - k
positional bytes: a list holds exactly the fingerprints that agree at those
positions, so a pair appears in a list only if its tally reaches the
minimum. Members of a list differ in the k masked bytes alone, at most
256**k distinct values, and are verified there bit by bit.

Equal fingerprints are one entry; lists emit a spanning forest of their
links, not their pairs, and groups are the connected components.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from parcelkit.llm.common import connected_components, prepare, row_key, tmp_names
from parcelkit.session import materialize

SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of a whole text; 0 for a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    counts, n, chunk = np.zeros(64, dtype=np.int64), 0, []
    for r in runs:
        chunk.append(digest(join(r), SEED))
        if len(chunk) == 65536:  # bounds the unpacked bits of a very long text
            counts, n, chunk = counts + _bits(chunk), n + len(chunk), []
    counts, n = counts + _bits(chunk), n + len(chunk)
    return int(np.packbits(2 * counts > n).view(">u8")[0])


def _bits(hashes: list) -> np.ndarray:
    """Set bits per position, highest bit first."""
    if not hashes:
        return np.zeros(64, dtype=np.int64)
    b = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(b, axis=1).sum(axis=0, dtype=np.int64)


def fingerprint_udf(shingle: int):
    @pandas_udf("long")
    def simhash(text: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in text], dtype=np.uint64).view(np.int64))
    return simhash


def index_keys(fp: str, max_bits: int):
    """Posting keys of a fingerprint: for each choice of ``max_bits`` masked
    positions, the bytes left and the choice itself. One long each for two or
    more masked bytes (48 bits and the choice's number)."""
    keys = []
    for c, masked in enumerate(combinations(range(8), max_bits)):
        left = [F.shiftright(F.col(fp), 8 * p).bitwiseAND(F.lit(0xFF)) for p in range(8) if p not in masked]
        key = F.lit(0).cast("long")
        for b in left:
            key = F.shiftleft(key, 8).bitwiseOR(b)
        keys.append(F.struct(F.lit(c).alias("c"), key.alias("key")))
    return F.array(*keys)


def _forest(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Spanning-forest links (rows a, b) among distinct fingerprints of one
    posting list: label of each entry is the smallest entry it reaches."""
    m = len(fps)
    if m == 2:
        near = int(fps[0] ^ fps[1]).bit_count() <= max_bits
        return fps.reshape(1, 2) if near else fps[:0].reshape(0, 2)
    fps = np.sort(fps)
    if m <= 256:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits
        i, j = np.nonzero(near)
    else:
        # All fingerprints within max_bits of an entry, looked up in the list.
        free = np.bitwise_or.reduce(fps ^ fps[0])
        bits = [1 << b for b in range(64) if int(free) >> b & 1]
        ii, jj = [], []
        for k in range(1, max_bits + 1):
            for flip in combinations(bits, k):
                want = fps ^ np.uint64(sum(flip))
                at = np.minimum(np.searchsorted(fps, want), m - 1)
                hit = np.nonzero(fps[at] == want)[0]
                ii.append(hit)
                jj.append(at[hit])
        i, j = np.concatenate(ii), np.concatenate(jj)
    label = np.arange(m)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        low = low[low]
        if (low == label).all():
            break
        label = low
    own = label != np.arange(m)
    return np.stack([fps[label[own]], fps[own]], axis=1)


def _links(max_bits: int):
    """Reads (c, key, fp) sorted by key, batch by batch, and yields the links
    of each list. Only the list that a batch ends in is carried over."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        held = None
        for batch in batches:
            cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("c", "key", "fp")]
            if held is not None:
                cols = [np.concatenate([h, x]) for h, x in zip(held, cols)]
            c, key, fp = cols
            if not len(key):
                continue
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (c[1:] != c[:-1])])
            held = [x[starts[-1]:] for x in cols]
            yield from emit(starts, fp)
        if held is not None:
            yield from emit(np.array([0, len(held[2])]), held[2])

    def emit(starts, fp):
        size = np.diff(starts)
        out = [_forest(fp[s:s + n].view(np.uint64), max_bits)
               for s, n in zip(starts[:-1][size > 1].tolist(), size[size > 1].tolist())]
        if out:
            e = np.concatenate(out).view(np.int64)
            if len(e):
                yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], schema=schema)
    return run


def fingerprint_groups(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(fp, root) of each distinct fingerprint that has a link; ``fps`` has one
    row per distinct fingerprint in column fp."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3")
    posts = (fps.select("fp", F.explode(index_keys("fp", max_bits)).alias("k"))
             .select("k.c", "k.key", "fp").repartition("c", "key").sortWithinPartitions("c", "key"))
    links = posts.mapInArrow(_links(max_bits), "a long, b long")
    return connected_components(links, "simhash").select(F.col("node").alias("fp"), "root")


def group_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, row (key of id and text),
    fingerprint (long) and component_id, the smallest doc_id reachable.

    Null and empty texts have fingerprint zero and are linked like any other;
    a null doc_id takes part but never names a component that has another
    id. Repeated rows each keep a row. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    marked = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), row_key(f"`{doc_id}`", f"`{text}`").alias("row"),
                         fingerprint_udf(shingle)(F.col(f"`{text}`")).alias("fp"))
    marked = materialize(marked, "simhash-docs")
    # From here to the last join there is one row per distinct fingerprint.
    each = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-fps")
    groups = fingerprint_groups(each, max_bits)
    rooted = each.join(groups, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(rooted.join(named, "root").select("fp", "component_id"), "simhash-named")
    return marked.join(named, "fp").select("doc_id", "row", F.col("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id
    (nulls last), ties by key. Rows equal in id and text are one document."""
    (key,) = tmp_names(docs, "simhash_row")
    groups = group_documents(docs, doc_id, text, shingle, max_bits)
    # A group whose ids are all null is named by its fingerprint's own row.
    named = F.struct(F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fingerprint")))
    first = groups.groupBy(named.alias("g")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("m")).select(F.col("m.row").alias(key))
    return (docs.withColumn(key, row_key(f"`{doc_id}`", f"`{text}`")).join(first, key, "left_semi")
            .dropDuplicates([key]).drop(key))
