"""Alignment of two tokenizers against plain loops over the libraries' own ids."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sparkrec.llm import align
from sparkrec.llm.encode import distinct_tokens
from sparkrec.llm.queries import QUERIES, tokenizer_path

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
EDGE = [(1, None), (2, ""), (None, "null id"), (3, "Hello  World \n\n it's <|endoftext|> </s><s> ok ² 漢字\ta"), (3, "again"),
        (4, "the " * 3000), (5, "a▁b"), (6, "   "), (7, " "), (8, "x "), (9, "ﬁ é　b \x00 <0x41>"), (10, "n" * 5000), (3, "again")]


def brute(rows):
    plain = Tokenizer.from_file(PATHS[0])
    plain.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    alphabet = align.byte_level_alphabet()
    found, corpus = [], Counter()
    for doc, text in rows:
        want = b" " + (text or "").encode()
        a = plain.encode(want.decode(), add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        bytes_a = [bytes(alphabet[c] for c in plain.id_to_token(i)) for i in a]
        pieces = [model.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            a, b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = np.cumsum([0, *map(len, bytes_a)]), np.cumsum([0, *map(len, bytes_b)])
        common = sorted(set(ends_a[1:]) & set(ends_b[1:]))
        groups, i, j = [], 0, 0
        for end in common:
            ni, nj = int(np.searchsorted(ends_a, end)), int(np.searchsorted(ends_b, end))
            groups.append(",".join(map(str, a[i:ni])) + "|" + ",".join(map(str, b[j:nj])))
            i, j = ni, nj
        links, j = [], 0
        for i in range(len(a)):
            while j and ends_b[j] > ends_a[i]:
                j -= 1
            while j < len(b) and ends_b[j] < ends_a[i + 1]:
                if ends_b[j + 1] > ends_a[i]:
                    links.append((a[i], b[j]))
                j += 1
        corpus.update(links)
        found.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = Counter()
    for (_, b), n in corpus.items():
        most[b] = max(most[b], n)
    return sorted((str(doc), na, nb, ng, len(links), sum(corpus[x] == most[x[1]] for x in links), sum(corpus[x] for x in links), sha)
                  for doc, na, nb, ng, links, sha in found)


def rows_of(df):
    cols = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((str(r["doc_id"]), *(r[c] for c in cols[1:])) for r in df.select(*cols).collect())


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    assert rows_of(QUERIES["op13_alignment"](spark, sf)) == brute(rows)


@pytest.mark.parametrize("heavy", [1 << 16, 4])
def test_edges_match_brute_force_with_few_heavy_pairs(spark, monkeypatch, heavy):
    monkeypatch.setattr(align, "HEAVY", heavy)
    docs = spark.createDataFrame(EDGE, "doc_id long, text string").selectExpr("*", "1 AS n_a", "2 AS row", "3 AS rid").repartition(3)
    found = align.digest(docs, *PATHS, keep=["doc_id", "n_a", "row"])
    assert rows_of(found.select("row.doc_id", *found.columns[1:])) == brute(EDGE)
    assert found.select("row.row").distinct().collect()[0][0] == 2
    assert align.digest(docs.limit(0), *PATHS, keep=["doc_id"]).count() == 0


def test_alignment_outputs_cover_the_text(spark):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string")
    for r in align.align(docs, *PATHS, keep=["doc_id", "text"]).collect():
        assert sum(r["group_a"]) == len(r["a"]) and sum(r["group_b"]) == len(r["b"])
        assert len(r["link_a"]) == len(r["link_b"]) == len(r["a"]) + len(r["b"]) - len(r["group_a"])
        assert set(r["link_a"]) == set(range(len(r["a"]))) and set(r["link_b"]) == set(range(len(r["b"])))
        assert list(zip(r["link_a"], r["link_b"])) == sorted(zip(r["link_a"], r["link_b"]))


@pytest.mark.parametrize("work", [1, 2, 7, 1000])
def test_pieces_of_any_size_give_the_same_links(work):
    rng = np.random.default_rng(work)
    for _ in range(30):
        n = int(rng.integers(1, 300))
        a, b = ([*np.flatnonzero(rng.random(n) < p).tolist(), n] for p in rng.random(2))
        got = align.merge_path(np.array(a), np.array(b), work)
        want = {(int(np.searchsorted(a, e)), int(np.searchsorted(b, e))) for e in {*a, *b}}
        assert len(got[0]) == len(want) and set(zip(got[0].tolist(), got[1].tolist())) == want
        assert [a[i] for i in got[2]] == [b[j] for j in got[3]] == sorted({*a} & {*b})
    assert [len(x) for x in align.merge_path(np.zeros(0, int), np.zeros(0, int), work)] == [0] * 4


def test_distinct_tokens_tells_all_bytes_apart(monkeypatch):
    rng = np.random.default_rng(0)
    for mixed in (None, lambda x: np.zeros_like(x)):  # the second joins all short tokens under one hash
        if mixed:
            monkeypatch.setattr("sparkrec.llm.encode.mix", mixed)
        data = rng.integers(0, 2, 3000).astype(np.uint8)
        first = np.unique(np.append(0, rng.integers(0, 3000, 700)))
        last = np.append(first[1:], 3000)
        at, kinds = distinct_tokens(data, first, last)
        tokens = [data[a:b].tobytes() for a, b in zip(first, last)]
        assert [tokens[at[k]] for k in kinds] == tokens and len({tokens[i] for i in at}) == len(at)
