"""Conversation structure repair by Wagner-Fischer target alignment.

A conversation's rows are aligned to the strings that its roles may spell: an
optional system turn, then user and assistant in turn. Rows are kept,
reroled or deleted and empty turns inserted, at the least cost; of equal
costs the audit (the edits' initials in order) that is least in ASCII.

The strings of all feasible lengths share their ends, so one Wagner-Fischer
matrix, filled from the last row back, has the cost of each length: cell
(i, r) is the cost of turning rows i, i + 1, ... into the last r turns. A
greedy repair gives the incumbent cost, and with it Ukkonen's band: cells off
the diagonal by more deletions or insertions than that cost pays for are
never filled. All lengths of the least cost are traced and their audits
compared. A leading system turn is one kept row before such a string.

A conversation whose band would not fit into memory (CELLS) is folded: the
costs of all lengths then are kept per state of the grammar, which gives the
same cost and audit in memory of a few bytes a row.

Rows are first reduced to their order, initial and fault, from which a task
streams each conversation's edits; the texts then stream past the edits. No
task holds the texts of a conversation.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from parcelkit.llm.common import BLANKS, prepare
from parcelkit.session import materialize

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
CELLS = 20_000_000
FAR = 1 << 40
ROLES = ("user", "assistant")

# A row's letter: s, u, a or x (any other initial), upper case if the row is
# truncated, or "-" if it must be deleted.


# --- the cheapest audit of one conversation ----------------------------------------------

def greedy(rows: str) -> int:
    """Cost of a simple repair of rows without forced deletions."""
    cost, expect, start = 0, "u", True
    for letter in rows:
        c = letter.lower()
        cost += TRUNCATED if letter != c else 0
        if start and c == "s":
            start, opened = False, True
            continue
        if c == expect or c in "ua":
            cost += 0 if c == expect else INSERT
            expect = "a" if c == "u" else "u"
        else:
            cost += REROLE
            expect = "a" if expect == "u" else "u"
        start, opened = False, False
    if expect == "a":
        cost += INSERT
    elif rows and not start and opened:
        cost += 2 * INSERT
    return min(cost, DELETE * len(rows))


def band(rows: str, incumbent: int) -> tuple[int, int]:
    """Most deletions and insertions of a repair that costs ``incumbent`` at
    most: a truncated row costs TRUNCATED in any case, one more if deleted."""
    t = sum(c.isupper() for c in rows)
    spare = incumbent - TRUNCATED * t
    over = DELETE - TRUNCATED
    few = spare // over if spare <= over * t else t + (spare - over * t) // DELETE
    return min(few, incumbent // DELETE, len(rows)), spare // INSERT


def matrix(rows: str, below: int, above: int) -> np.ndarray:
    """Cell [i, below + r - (n - i)]: least cost of turning rows[i:] into the
    last r turns, inside the band."""
    n, width = len(rows), below + above + 1
    step = INSERT * np.arange(width)
    cost = np.full((n + 1, width + 1), FAR, dtype=np.int64)
    offset = np.arange(-below, above + 1)
    cost[n, :width] = np.where(offset >= 0, INSERT * offset, FAR)
    for i in range(n - 1, -1, -1):
        r = n - i + offset
        c, late = rows[i].lower(), TRUNCATED if rows[i].isupper() else 0
        fits = (r % 2 == 0) if c == "u" else (r % 2 == 1) if c == "a" else np.zeros(width, dtype=bool)
        use = np.where(fits, 0, REROLE) + late + cost[i + 1, :width]
        row = np.minimum(DELETE + cost[i + 1, 1:], np.where(r > 0, use, FAR))
        row[r < 0] = FAR
        cost[i, :width] = np.minimum.accumulate(row - step) + step
        cost[i, :width][r < 0] = FAR
    return cost


def trace(rows: str, cost: np.ndarray, below: int, i: int, r: int) -> str:
    """The least audit of cell (i, r)."""
    n, out = len(rows), []
    width = cost.shape[1] - 1

    def at(i, r):
        k = below + r - (n - i)
        return cost[i, k] if r >= 0 and 0 <= k < width else FAR

    while i < n or r:
        v = at(i, r)
        if i < n and DELETE + at(i + 1, r) == v:
            i, edit = i + 1, "D"
        elif r and INSERT + at(i, r - 1) == v:
            r, edit = r - 1, "I"
        else:
            edit = "K" if rows[i].lower() == "au"[r % 2 == 0] else "R"
            i, r = i + 1, r - 1
        out.append(edit)
    return "".join(out)


def align(rows: str) -> tuple[int, str]:
    """(cost, audit) of rows without forced deletions, length by length."""
    n, incumbent = len(rows), greedy(rows)
    below, above = band(rows, incumbent)
    if (n + 1) * (below + above + 2) > CELLS:
        return fold(rows)
    cost = matrix(rows, below, above)
    found: dict[int, list] = {}

    def offer(c, *where):
        if c <= incumbent:
            found.setdefault(int(c), []).append(where)

    for r in range(n + above, -1, -1):  # target (ua)*, of each even length
        k = below + r - n
        if r % 2 == 0 and k >= 0:
            offer(cost[0, k], 0, r)
    for p in range(min(n, below + 1)):  # s(ua)+, its s kept from row p
        if rows[p] in "sS":
            lead = DELETE * p + (TRUNCATED if rows[p] == "S" else 0)
            for r in range(2, n - p - 1 + above + 1, 2):
                k = below + r - (n - p - 1)
                if k >= 0:
                    offer(lead + cost[p + 1, k], p + 1, r)
    best = min(found)
    return best, min("D" * (i - 1) + "K" * (i > 0) + trace(rows, cost, below, i, r) for i, r in found[best])


def fold(rows: str) -> tuple[int, str]:
    """As ``align``, with the lengths folded into the grammar's states: 0
    nothing yet, 1 after s, 2 after u, 3 after a."""
    n = len(rows)
    after = (2, 2, 3, 2)
    cost = np.zeros((n + 1, 4), dtype=np.int64)
    cost[n] = 0, 2 * INSERT, INSERT, 0

    def use(i, s):
        c, late = rows[i].lower(), TRUNCATED if rows[i].isupper() else 0
        e = "a" if s == 2 else "u"
        return ("K" if c == e else "R"), (0 if c == e else REROLE) + late + int(cost[i + 1, after[s]]), late

    for i in range(n - 1, -1, -1):
        best = []
        for s in range(4):
            _, v, late = use(i, s)
            if s == 0 and rows[i] in "sS":
                v = min(v, late + int(cost[i + 1, 1]))
            best.append(min(v, DELETE + int(cost[i + 1, s])))
        best[2] = min(best[2], INSERT + best[3])
        best[3] = min(best[3], INSERT + best[2])
        for s in (0, 1):
            best[s] = min(best[s], INSERT + best[2])
        cost[i] = best
    i, s, out = 0, 0, []
    while i < n or s in (1, 2):
        v = int(cost[i, s])
        if i < n and DELETE + int(cost[i + 1, s]) == v:
            i, edit = i + 1, "D"
        elif INSERT + int(cost[i, after[s]]) == v:
            s, edit = after[s], "I"
        else:
            edit, c, late = use(i, s)
            if s == 0 and rows[i] in "sS" and late + int(cost[i + 1, 1]) == v:
                s, edit = 1, "K"
            else:
                s = after[s]
            i += 1
        out.append(edit)
    return int(cost[0, 0]), "".join(out)


@lru_cache(maxsize=50_000)
def _short(rows: str) -> tuple[int, str]:
    return align(rows)


def repair_audit(rows: str) -> tuple[int, str]:
    """(cost, audit) of a conversation's row letters. A row that must go is
    deleted at once, before what may be inserted at its place."""
    free = rows.replace("-", "")
    cost, audit = _short(free) if len(free) <= 64 else align(free)
    forced = len(rows) - len(free)
    if not forced:
        return cost, audit
    out, at = [], 0
    for letter in rows:
        if letter == "-":
            out.append("D")
            continue
        end = at
        while audit[end] == "I":
            end += 1
        out.append(audit[at:end + 1])
        at = end + 1
    return cost + DELETE * forced, "".join(out) + audit[at:]


# --- rows -> edits -> repaired rows --------------------------------------------------------

def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, lost): rows damaged by a checksum of id and
    turn; a null role or text is one space, as is a null in the checksum's
    text. Lost rows stay, marked, so that their conversation is known."""
    space = F.lit(" ")
    r = rows.select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
                    F.coalesce(F.col(f"`{role}`"), space).alias("role"),
                    F.coalesce(F.col(f"`{text}`"), space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    r = r.withColumn("kind", F.crc32(key.cast("binary")) % 20)
    r = r.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))))
    return r.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"), (F.col("kind") == 0).alias("lost"))


def _clean(rows: DataFrame, lost: str | None) -> DataFrame:
    gone: Column = F.coalesce(F.col(f"`{lost}`"), F.lit(False)) if lost else F.lit(False)
    space = F.lit(" ")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                       gone.alias("lost")).withColumn("print", F.unhex(F.sha2("text", 256)))


def _in_order(rows: DataFrame) -> DataFrame:
    """Each conversation in one partition, its rows by part and turn."""
    return rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", F.col("turn").asc_nulls_first(), "role", "print")


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
AUDIT = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"
_AUDIT = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string())])


def _grouped(batches, *names):
    """(conv_id, its rows) of rows sorted by conv_id; rows are read as asked."""
    def rows():
        for b in batches:
            yield from zip(b.column("conv_id").to_pylist(), *(b.column(n).to_pylist() for n in names))
    return groupby(rows(), key=lambda r: r[0])


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _audit(batches):
    out = []
    for conv, rows in _grouped(batches, "turn", "initial", "fault"):
        letters, before = [], None
        count = dict.fromkeys("bdt", 0)
        low = high = None
        distinct = illegal = 0
        for _, turn, initial, fault in rows:
            if fault == "l":  # lost
                continue
            if turn is not None and turn != high:
                low, high, distinct = turn if low is None else low, turn, distinct + 1
            c = initial if initial in ("s", "u", "a") else "x"
            if before is not None:
                illegal += before + c not in ("su", "ua", "au")
            before = c
            if fault in count:
                count[fault] += 1
            letters.append("-" if fault in "bd" else c.upper() if fault == "t" else c)
        cost, audit = repair_audit("".join(letters))
        gaps = high - low + 1 - distinct if distinct else 0
        out.append((conv, gaps, count["b"], count["d"], count["t"], illegal, cost, audit))
        if len(out) >= 5000:
            yield _batch(out, _AUDIT)
            out = []
    yield _batch(out, _AUDIT)


def audits(rows: DataFrame, lost: str | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost and audit.

    ``rows`` has conv_id, turn, role and text; rows whose column ``lost`` is
    true only make their conversation known. Rows go by turn (nulls first),
    equal turns by role and the text's SHA-256; a null role or text is one
    space; null conv_ids are one conversation. A conversation without rows
    has zeros and an empty audit. Other columns are left out; an empty table
    gives an empty result.
    """
    return _audits(_clean(rows, lost))


def _audits(clean: DataFrame) -> DataFrame:
    prepare(clean.sparkSession)
    body = F.rtrim("text", F.lit(BLANKS))
    r = clean.select("conv_id", "turn", "role", "print", F.substring("role", 1, 1).alias("initial"), "lost",
                     (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    seen = Window.partitionBy("conv_id", "lost", "role", "print").orderBy(F.col("turn").asc_nulls_first())
    r = r.withColumn("nth", F.row_number().over(seen))
    fault = (F.when(F.col("lost"), "l").when(F.col("blank"), "b").when(F.col("nth") > 1, "d")
             .when(F.col("cut"), "t").otherwise("-"))
    r = r.select("conv_id", "turn", "role", "print", "initial", fault.alias("fault"), F.lit(0).alias("part"))
    ordered = _in_order(r).select("conv_id", "turn", "initial", "fault")
    return ordered.mapInArrow(_audit, AUDIT)


def _edits(audit: str, rows):
    """(edit, role, text) of a conversation's rows in order."""
    odd = (len(audit) - audit.count("D")) % 2
    place, at = 0, 0

    def wanted():
        return ROLES[(place - odd) % 2]

    for role, text in rows:
        while audit[at] == "I":
            yield "I", wanted(), ""
            place, at = place + 1, at + 1
        edit = audit[at]
        at += 1
        if edit != "D":
            yield edit, role if edit == "K" else wanted(), text
            place += 1
    for edit in audit[at:]:
        yield edit, wanted(), ""
        place += 1


def _beside(clean: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one partition."""
    none = F.lit(None)
    told = found.select("conv_id", F.lit(0).alias("part"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
                        none.cast("string").alias("text"), none.cast("binary").alias("print"),
                        F.struct(*COUNTS, "audit").alias("told"))
    said = clean.where(~F.col("lost")).select("conv_id", F.lit(1).alias("part"), "turn", "role", "text", "print",
                                              none.cast(told.schema["told"].dataType).alias("told"))
    return _in_order(told.union(said)).select("conv_id", "role", "text", "told")


_REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                       ("text", pa.string())])


def _repaired(batches):
    out, held = [], 0
    for conv, rows in _grouped(batches, "role", "text", "told"):
        audit = next(rows)[3]["audit"]
        for place, (edit, role, text) in enumerate(_edits(audit, ((r[1], r[2]) for r in rows))):
            out.append((conv, place, edit, role, text))
            held += len(text)
            if len(out) >= 2000 or held > 4_000_000:
                yield _batch(out, _REPAIRED)
                out, held = [], 0
    yield _batch(out, _REPAIRED)


def repair(rows: DataFrame, lost: str | None = None) -> DataFrame:
    """(conv_id, place, edit, role, text): the repaired conversations, each
    turn with its place from 0 and the edit that made it (Keep, Rerole,
    Insert). Rows, nulls and empty tables as for ``audits``."""
    clean = _clean(rows, lost)
    return _beside(clean, _audits(clean)).mapInArrow(
        _repaired, "conv_id long, place long, edit string, role string, text string")


_DIGEST = _AUDIT.append(pa.field("repaired_sha256", pa.string()))


def _digest(batches):
    out = []
    for conv, rows in _grouped(batches, "role", "text", "told"):
        told, sha = next(rows)[3], hashlib.sha256()
        for place, (_, role, text) in enumerate(_edits(told["audit"], ((r[1], r[2]) for r in rows))):
            sha.update((("\n" if place else "") + role + ":").encode("utf-8", "replace"))
            sha.update(text.encode("utf-8", "replace"))
        out.append((conv, *(told[c] for c in COUNTS), told["audit"], sha.hexdigest()))
        if len(out) >= 5000:
            yield _batch(out, _DIGEST)
            out = []
    yield _batch(out, _DIGEST)


def digests(rows: DataFrame, lost: str | None = None) -> DataFrame:
    """``audits`` with repaired_sha256: the digest of the repaired turns,
    ``role:text`` joined by line ends. The audits are stored between the two
    passes, so that the texts are shuffled once."""
    clean = _clean(rows, lost)
    found = materialize(_audits(clean), "turns-audits")
    return _beside(clean, found).mapInArrow(_digest, AUDIT + ", repaired_sha256 string")
