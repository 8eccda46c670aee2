"""Conversation repair against exhaustive search and a plain rendering."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from conftest import SF001
from parcelkit.llm import turns as T

GRAMMAR = re.compile(r"(s?(ua)+)?")


def plain_audit(rows):
    """Cheapest-first search over all edits: (cost, least audit)."""
    heap = [(0, "", 0, "")]
    best = None
    done = set()
    limit = 2 * len(rows) + 3
    while heap:
        cost, audit, i, spelt = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            break
        if i == len(rows) and GRAMMAR.fullmatch(spelt):
            best = min(best or (cost, audit), (cost, audit))
            continue
        if (audit, spelt) in done or len(spelt) > limit or not prefix(spelt):
            continue
        done.add((audit, spelt))
        for c in "ua":
            heapq.heappush(heap, (cost + 3, audit + "I", i, spelt + c))
        if i < len(rows):
            letter = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, spelt))
            if letter != "-":
                late = 3 if letter.isupper() else 0
                heapq.heappush(heap, (cost + late, audit + "K", i + 1, spelt + letter.lower()))
                for c in "ua":
                    heapq.heappush(heap, (cost + late + 3, audit + "R", i + 1, spelt + c))
    return best


def prefix(spelt):
    return re.fullmatch(r"s?(ua)*u?", spelt) is not None


@pytest.mark.parametrize("n", range(0, 4))
def test_audits_of_all_short_conversations(n):
    for rows in itertools.product("suaxSUAX-", repeat=n):
        rows = "".join(rows)
        assert T.repair_audit(rows) == plain_audit(rows), rows


def test_audits_of_longer_conversations():
    rng = random.Random(7)
    for _ in range(150):
        rows = "".join(rng.choices("suaxUA-", weights=[1, 6, 6, 1, 1, 1, 1], k=rng.randint(4, 8)))
        assert T.repair_audit(rows) == plain_audit(rows), rows


def test_folding_gives_the_same(monkeypatch):
    rng = random.Random(11)
    cases = ["".join(rng.choices("suaxSUAX", weights=[1, 6, 6, 1, 1, 2, 2, 1], k=rng.randint(0, 60))) for _ in range(400)]
    cases += ["ua" * 700 + "u" * 40 + "sUxA" * 30, "s" * 300, "A" * 257]
    banded = [T.align(c) for c in cases]
    monkeypatch.setattr(T, "CELLS", 0)
    for c, want in zip(cases, banded):
        assert T.align(c) == want, c


def test_band_leaves_cells_out():
    rows = "ua" * 1000
    assert T.greedy(rows) == 0 and T.band(rows, 0) == (0, 0)
    cost, audit = T.align("ua" * 500 + "u" + "ua" * 500)
    assert cost == 3 and audit == min(audit, "K" * 1001 + "I" + "K" * 1000)
    below, above = T.band(rows, 30)
    assert below + above < 20


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        kept = out.setdefault(conv, [])
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_digest(rows):
    sha = hashlib.sha256
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r[2].encode()).digest()))
    letters, seen = "", set()
    count = {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        c = role[:1] if role[:1] in ("s", "u", "a") else "x"
        if not body:
            count["blank"] += 1
            c = "-"
        elif (role, text) in seen:
            count["duplicate"] += 1
            c = "-"
        elif body[-1] not in ".!?":
            count["truncated"] += 1
            c = c.upper()
        seen.add((role, text))
        letters += c
    at = [r[0] for r in rows if r[0] is not None]
    gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = T.repair_audit(letters)
    spelt = len(audit) - audit.count("D")
    target = "s" * (spelt % 2) + "ua" * (spelt // 2)
    said, left = [], list(rows)
    for edit in audit:
        row = None if edit == "I" else left.pop(0)
        if edit == "D":
            continue
        name = {"u": "user", "a": "assistant"}.get(target[len(said)])
        said.append(f"{row[1]}:{row[2]}" if edit == "K" else f"{name}:{row[2] if row else ''}")
    digest = sha("\n".join(said).encode()).hexdigest()
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest), said


def key(r):
    return tuple((v is not None, v) for v in r)


def test_query_is_the_plain_one(spark, queries):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = queries["op13_conversation_repair"](spark, SF001).collect()
    want = [(c, *plain_digest(r)[0]) for c, r in plain_damage(rows).items()]
    assert sorted(map(tuple, got)) == sorted(want)


ROWS = [(1, 0, "user", "Hello there."), (1, 1, "assistant", "General."), (1, 1, "assistant", "General."),
        (1, 1, "assistant", "Another at the turn."), (1, None, "system", "Be brief."), (1, 7, None, None), (1, 9, "", "x"),
        (2, None, None, None), (2, None, "user", "No turn!"), (2, None, "user", "No turn!"),
        (3, 5, "tool", "Result\n\x0b"), (3, 6, "Assistant", "said. \t"), (3, 8, "user", "W" * 200_000 + "?"),
        (None, 1, "assistant", "no id."), (None, 2, "user", "no id either."), (None, None, "s", "sys"),
        *((4, t, "user", "all the same.") for t in range(200)), *((5, t, "ua"[t % 2], f"turn {t}.") for t in range(300))]


def test_edge_rows(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    clash = df.selectExpr("*", "1 AS lost_", "'y' AS fault", "2 AS part", "3 AS print", "'k' AS kind", "4 AS copy")
    got = T.digests(T.damage(clash), "lost").collect()
    plain = plain_damage(ROWS)
    assert sorted(map(tuple, got), key=key) == sorted(((c, *plain_digest(r)[0]) for c, r in plain.items()), key=key)
    turned = {}
    for r in T.repair(T.damage(clash), "lost").orderBy("place").collect():
        turned.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert turned == {c: said for c, (_, said) in ((c, plain_digest(r)) for c, r in plain.items()) if said}
    for said in turned.values():
        assert GRAMMAR.fullmatch("".join(s[0] for s in said))


def test_lost_conversation_and_empty_table(spark):
    df = spark.createDataFrame([(1, 1, "user", "a.", True)], "conv_id long, turn long, role string, text string, lost boolean")
    got = T.digests(df, "lost").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert T.digests(df.where("false"), "lost").count() == 0
    assert T.repair(df.where("false"), "lost").count() == 0
