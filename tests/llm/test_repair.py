"""Conversation repair against exhaustive search, whole and cut into small pieces."""

import hashlib
import heapq
import re
import zlib
from itertools import product

import numpy as np
import pytest

from sparkrec.llm import repair

SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit, repaired) by uniform-cost search over rows, state and audit; rows are (fault, role, text)."""
    heap = [(0, "", 0, "", ())]
    while True:
        cost, audit, at, initials, out = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, out
        nexts = [(role, initials + role[0]) for role in ("user", "assistant") if re.fullmatch("s|s?(ua)*u|s?(ua)+", initials + role[0])]
        for role, now in nexts:
            if cost < 3 * (len(rows) + 2) * 3:
                heapq.heappush(heap, (cost + 3, audit + "I", at, now, (*out, f"{role}:")))
        if at < len(rows):
            fault, role, text = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, initials, out))
            if fault in ("", "truncated"):
                extra = 3 * (fault == "truncated")
                if role and re.fullmatch("s|s?(ua)*u|s?(ua)+", initials + role[0]):
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, initials + role[0], (*out, f"{role}:{text}")))
                for other, now in nexts:
                    heapq.heappush(heap, (cost + 3 + extra, audit + "R", at + 1, now, (*out, f"{other}:{text}")))


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def brute(rows, damage=True):
    out = []
    after = list(damaged(rows)) if damage else rows
    for conv in dict.fromkeys(r[0] for r in rows):
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        marked, seen = [], set()
        for _, _, role, text in mine:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((fault, role, text))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = [sum(m[0] == f for m in marked) for f in ("blank", "duplicate", "truncated")]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, fixed = cheapest(marked)
        out.append((str(conv), gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(fixed).encode()).hexdigest()))
    return sorted(out)


def rows_of(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def random_rows(seed, convs, turns):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "u", "Assistant"]
    texts = ["Fine.", "Cut off", "Why?  \n", None, "", "\t ", "é!", "x", "Ask. "]
    return [
        (c or None, None if rng.random() < 0.1 else t, roles[min(int(rng.exponential(1.2)), 7)],
         (texts[int(rng.integers(len(texts)))] or "") + f" {rng.integers(3)}." * int(rng.random() < 0.4))
        for c in range(convs) for t in range(int(rng.integers(0, turns)))]


@pytest.mark.parametrize("piece", [1024, 2])
def test_random_conversations_match_search(spark, piece):
    rows = random_rows(piece, 60, 8) + [(99, None, "user", "a."), (99, None, "user", "a."), (98, 5, None, None)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS place", "2 AS fault")
    given = repair.read_rows(docs.repartition(3))
    assert rows_of(repair.digest(given, repair.repair(repair.damage(given), piece))) == brute(rows)


def test_one_conversation_over_many_tasks(spark):
    rng = np.random.default_rng(5)
    rows = [(7, t, ["user", "assistant", "system"][int(rng.integers(3))], f"{['ok.', 'cut', 'Yes!'][int(rng.integers(3))]}{rng.integers(9)}."
             if rng.random() < 0.9 else " ") for t in range(60)]
    codes = []
    seen = set()
    for _, _, role, text in rows:
        fault = "blank" if not text.strip() else "duplicate" if (role, text) in seen else "truncated" if text[-1] not in ".!?" else ""
        seen.add((role, text))
        codes.append(repair.code(fault, role))
    costs = (0, 6, 3, 0)
    want, state = repair.walk(bytes(codes), costs, 0, True)
    given = repair.read_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))
    edits = repair.repair(given, 3)
    assert edits.select("place").distinct().count() >= 20
    found = repair.digest(given, edits).collect()
    assert [r["audit"] for r in found] == [want]
    left = [r["role"] for r in edits.filter("edit <> 'D'").orderBy("place", "at").collect()]
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in left))


def test_walk_equals_search_on_all_short_inputs():
    kinds = [("blank", "user"), ("truncated", "assistant"), ("", "user"), ("", "assistant"), ("", "system"), ("truncated", "tool")]
    for n in range(4):
        for rows in product(kinds, repeat=n):
            got, _ = repair.walk(bytes(repair.code(f, r) for f, r in rows), repair.FINAL, 0, True)
            assert got == cheapest([(f, r, "x") for f, r in rows])[1], rows


def test_empty_table(spark):
    none = repair.read_rows(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert repair.digest(none, repair.repair(repair.damage(none))).count() == 0
