"""Jaccard join against all pairs, with single shingles and with combinations forced everywhere."""

import re

import numpy as np
import pytest

from sparkrec.llm import common, ngram_join
from sparkrec.llm.common import table

SF = "/root/testdata/sf0.001"


def brute(rows):
    sets = []
    for _, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(words[i:i + 4]) for i in range(max(len(words) - 3, 1))} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((str(doc), len(sets[i]), str(least.get(find(i)))) for i, (doc, _) in enumerate(rows))


def rows_of(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def edited(rng, words, n):
    words = list(words)
    for at in rng.choice(len(words), n, replace=False):
        words[at] = f"w{rng.integers(10 ** 6)}"
    return " ".join(words)


@pytest.mark.parametrize("frequent, very, block", [(16, 256, 4096), (0, 1e9, 7), (0, 0, 7)])
def test_documents_and_planted_copies_match_all_pairs(spark, monkeypatch, frequent, very, block):
    for name, value in (("FREQUENT", frequent), ("VERY_FREQUENT", very), ("BLOCK_NODES", block), ("PAIR_BLOCK", block)):
        monkeypatch.setattr(ngram_join, name, value)
    monkeypatch.setattr(common, "HOT", 5)
    monkeypatch.setattr(common, "HOT_LEAST", 7)
    rng = np.random.default_rng(1)
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    base = [f"t{rng.integers(3000)}" for _ in range(170)]
    rows += [(9000 + i, edited(rng, base, int(rng.integers(1, 9)))) for i in range(60)]
    rows += [(9100 + i, " ".join(base[:60]) + " " + " ".join(f"u{rng.integers(3000)}" for _ in range(40))) for i in range(30)]
    rows += [(None, "null id here it is"), (None, None), (9200, ""), (9201, " \t\n"), (9202, "ONE two"), (9203, "one  two"), (9204, "one"),
             (9205, "ÀB c d e"), (9206, "àB c d e"), (9207, "NULL id here it is"), (9000, "again the same id"), (9000, "again the same id"),
             (9208, "x y " * 9000), (9209, "x y " * 300), (9210, "a\x1cb c d e"), (9211, "a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS n").repartition(4)
    assert rows_of(ngram_join.components(docs, min(block, 256))) == brute(rows)


def test_empty_table(spark):
    assert ngram_join.components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_linked_sets_share_a_signature_of_any_class():
    rng = np.random.default_rng(3)
    levels = rng.integers(0, 8, 1 << ngram_join.COUNTER_BITS).astype(np.uint8)
    for trial in range(400):
        takes = rng.integers(1, 4, 256).astype(np.int8) if trial % 4 else np.full(256, trial // 4 % 3 + 1, np.int8)
        n = int(rng.integers(1, 1200)) if trial % 3 else int(rng.integers(1, 12))
        keys = np.unique(rng.integers(0, 1 << 63, 2 * n).astype(np.uint64))
        drop = int(rng.integers(0, ngram_join.allowed(n) + 1))
        add = 0
        while 100 * (n - drop) >= 85 * (n + add + 1) and rng.random() < 0.9:
            add += 1
        x, y = keys[:n], np.sort(np.concatenate([rng.permutation(keys[:n])[drop:], keys[n:n + add]]))
        if 100 * (n - drop) < 85 * (n + add):
            continue
        a, b = ({int(s) for _, got in ngram_join.signatures(k, levels, takes) for s in got} for k in (x, y))
        assert a & b, (n, drop, add)
        assert len(a) <= 8 * (len(x) + 10)


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for n in (1, 5, 70, 900):
        keys = np.unique(rng.integers(0, 1 << 63, n + 40).astype(np.uint64))
        x, y = keys[:n], keys[n // 9:]
        kind = n.bit_length() - 1
        a, b = (np.frombuffer(ngram_join.sketch(k, kind), np.uint64) for k in (x, y))
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))


def test_node_lists_of_sorted_rows_in_any_batches():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    rows = np.unique(np.stack([rng.integers(0, 60, 400) << 6 | 9, rng.integers(0, 40, 400)], 1), axis=0)
    want = {}
    for sig, node in rows.tolist():
        want.setdefault(sig, []).append(node)
    doubled = np.repeat(rows, rng.integers(1, 3, len(rows)), axis=0)
    for size, most in ((1, 4), (7, 100), (1000, 3), (50, 6)):
        batches = [pa.RecordBatch.from_arrays([pa.array(doubled[a:a + size, k]) for k in (0, 1)], ["sig", "node"])
                   for a in range(0, len(doubled), size)]
        single, lists = {}, []
        for batch in ngram_join._lists(iter(batches), most):
            for r in batch.to_pylist():
                assert r["kind"] == 9
                if r["sig"] is None:
                    lists.append(r["nodes"])
                else:
                    single.setdefault(r["sig"], []).append(r["nodes"][0])
        ends = {rows[0, 0], rows[-1, 0]}
        assert sorted(lists) == sorted(n for s, n in want.items() if 1 < len(n) <= most and s not in ends)
        assert all(sorted(set(n)) == want[s] for s, n in single.items())
        assert single.keys() == ends | {s for s, n in want.items() if len(n) > most}
