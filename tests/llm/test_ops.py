"""Search, packing, extraction, URL filter, language, chat, toxicity and token files on the tables and on edge rows."""

import html
import re
import time
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from sparkrec.llm import chat, html_text, langid, packing, tokenfiles, topk, toxicity, urls
from sparkrec.llm.common import table
from sparkrec.llm.encode import Encoder
from sparkrec.llm.queries import ORACLE, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.01"
HALF = "".join("ab"[i.bit_count() % 2] for i in range(4096))  # equal polynomial hashes modulo 2**64 as its complement
DOCS = [(1, None), (2, ""), (None, "null id"), (3, "Hello  World\n\n it's <|endoftext|> ok ² 漢字\ta"), (3, "again"), (4, "the " * 5000)]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "pages", "conversations", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE[name])
    names = sorted(c[0] for c in want.description)
    rows = QUERIES[name](spark, SF)
    assert sorted(rows.columns) == names
    rows = rows.select(*(c[0] for c in want.description)).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want.fetchall()))


def test_top_k_edges(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [nan, 1.0]), (3, [0.5, None]), (4, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [1.0, 0.0]),
            (7, [2.0]), (None, [1.0, 1.0]), (50, [0.25, 0.0]), (8, []), (9, [-3e7, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS query_id", "2 AS score")
    got = sorted(tuple(r) for r in topk.top_k(df, lambda ids: ids % 50 == 0, 2).collect())
    assert got == [(0, 1, 4, 65536), (0, 2, 5, 65536), (50, 1, 0, 16384), (50, 2, 4, 16384)]
    assert topk.top_k(df.limit(0), lambda ids: ids % 50 == 0, 2).count() == 0
    wide = spark.createDataFrame([(0, [3e5, 1.0]), (1, [3e5, -2.0]), (2, [2e7, 0.0])], "vec_id long, embedding array<double>")
    assert [(r["vec_id"], r["score"]) for r in topk.top_k(wide, lambda ids: ids == 0, 2).orderBy("rank").collect()] == [
        (2, 76_800_000 * 5_120_000_000), (1, 76_800_000 ** 2 - 256 * 512)]
    with pytest.raises(ValueError, match="64 bits"):
        topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [1e30])], "vec_id long, embedding array<double>"), lambda ids: ids == 0, 2)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name):
    plain = Tokenizer.from_file(tokenizer_path(name))
    plain.encode_special_tokens = True
    texts = [t or "" for _, t in DOCS] + ["a\n\n b  c \n", "  x  ", " \n ", "don't 'S HE'LL", "ÄÖ ß çé 12 3x _y_", "x" * 3000,
                                          "a\r\nb\x0bc", HALF + "\n" + HALF.translate({97: 98, 98: 97}), "é" * 9, "é İ Σς", " a b"]
    encoder = Encoder(tokenizer_path(name))
    for got in (encoder.encode_all(texts), encoder.encode_all(texts)):
        for text, ids in zip(texts, got):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_packing_and_files_round_trip(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS part").repartition(3)
    path = tokenizer_path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    want = sorted(np.array(plain.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes() for _, t in DOCS)
    pieces = packing.pack(docs, path, 1, window=64).collect()
    whole = {}
    for r in sorted(pieces, key=lambda r: r["sequence_id"]):
        assert r["length"] & (r["length"] - 1) == 0 and r["length"] <= 64 and len(r["ids"]) == 4 * r["length"]
        if r["start"] == 0:
            whole[r["sequence_id"]] = b""
            last = r["sequence_id"]
        whole[last] += bytes(r["ids"])
    assert sorted(whole.values()) == want
    out = str(tmp_path / "ids")
    tokenfiles.write_token_files(docs, out, path, 1, shard_ids=50)
    rows = tokenfiles.with_global_start(tokenfiles.read_token_files(spark, out)).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 3, 4]
    assert sorted(r["ids_crc32"] for r in rows) == sorted(zlib.crc32(w) for w in want)
    assert [r["start"] for r in rows] == np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1].tolist()
    assert packing.pack(docs.limit(0), path, 1).count() == 0
    tokenfiles.write_token_files(docs.limit(0), out + "0", path, 1)
    assert tokenfiles.read_token_files(spark, out + "0").count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_unmodified_library(name):
    plain = Tokenizer.from_file(tokenizer_path(name))
    texts = [t or "" for _, t in DOCS] + ["a <|endoftext|> b", "<|startoftext|>A<|endoftext|>", "<|ENDOFTEXT|> b", "<|endoftext|", "é<|endoftext|>é",
                                          "漢 <|endoftext|>\n\n字", "x <|endoftext|>" * 2000, "endoftext|> it's"]
    encoder = Encoder(tokenizer_path(name), added_tokens=True)
    for got in (encoder.encode_all(texts), encoder.encode_all(texts)):
        for text, ids in zip(texts, got):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_queries_give_the_ids_of_an_unmodified_library(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for query, name, end in [("op10_token_files", "byte_bpe_50k.json", 2), ("op2_packing", "word_bpe_49k.json", 1)]:
        plain = Tokenizer.from_file(tokenizer_path(name))
        want = [np.array(plain.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for _, t in DOCS]
        rows = QUERIES[query](spark, str(tmp_path)).collect()
        if query == "op10_token_files":
            assert sorted((r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted((len(w), zlib.crc32(w.tobytes())) for w in want)
        else:
            crcs = sorted(zlib.crc32(w[at:at + n].tobytes()) for w in want
                          for at, n in zip(np.cumsum([0, *packing.piece_lengths(len(w), packing.WINDOW)]), packing.piece_lengths(len(w), packing.WINDOW)))
            assert sorted(r["ids_crc32"] for r in rows) == crcs
    packed = corpus_pipeline.packed(spark, docs, str(tmp_path)).collect()
    assert sorted(r["ids_crc32"] for r in packed) == crcs


def test_elias_fano_select():
    rng = np.random.default_rng(2)
    for values in (np.zeros(1, int), np.cumsum(rng.integers(0, 900, 1000)), np.cumsum(rng.integers(0, 2, 700)), np.array([0, 2 ** 40])):
        data = tokenfiles.ef_encode(values)
        f = tokenfiles.EliasFano(b"xx" + data, 2)
        assert f.all().tolist() == values.tolist() == [f.select(i) for i in range(f.n)] and f.end == 2 + len(data)
    assert len(tokenfiles.ef_encode(np.cumsum(rng.integers(0, 900, 9000)))) < 9000 * 2


def test_html_matches_brute_force(spark):
    got = {r["page_id"]: r["text"] for r in QUERIES["op3_html_text"](spark, SF).collect()}
    for r in table(spark, SF, "pages").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", article)]
        assert got[r["page_id"]] == "\n\n".join(b for b in blocks if b)


def test_html_templates_and_edges(spark):
    rows = [(i, f"http://h.x/{i}", f"<body><div><p>Our shop since 1990<p>Call us</div><p>Text number {i}<p>Shared line</body>")
            for i in range(8)]
    rows += [(90, None, "<p>a &lt; b<script>x</script>"), (91, "http://h.x/9", None), (92, "h", ""), (93, "http://h.x/0", "<div" * 500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' AS text", "'q' AS host")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert got[3] == "Text number 3" and got[90] == "a < b" and got[91] == got[92] == ""
    assert html_text.extract(pages.limit(0)).count() == 0
    page = "<main><h1>T</h1><article class=comment>no</article><p>One<b>two</b><p>x<br>y<form>f</form></main><aside>s"
    assert html_text.main_text(html_text.parse(page), set()) == "T\n\nOnetwo\n\nx y"


@pytest.mark.parametrize("page, want", [
    ("<div class='layout has-sidebar'><article><p>Long text</article></div>", "Long text"),
    ("<div class='with-header'><p>Long text</div>", "Long text"),
    ("<article class='post comments-open'><p>Long text</article>", "Long text"),
    ("<form id=aspnetForm><div><a href=/>Menu of this site</a></div><article><p>Text</article></form>", "Text"),
    ("<form id=aspnetForm><div class=menu>Menu</div><p>Long text</form>", "Long text"),
    ("<div class=widget><main><p>Long text</main></div><p>x", "Long text"),
    ("<main><h1>T</h1><div class=widget><article><p>Long text</article></div></main>", "T\n\nLong text"),
    ("<article class=notice><p>Long text</article>", "Long text"),
    ("<div class=comments><article><p>Long text</article></div>", "Long text"),
    ("<p>Text<div class=comments><article><p>A longer comment</article></div>", "Text"),
    ("<article><p>Text<div class=comments><p>A longer comment</div></article>", "Text"),
    ("<p>A longer text<aside class=related><article>Other</article></aside>", "A longer text"),
    ("<article><p>Text<div class='comments-area'><p>A longer comment</div></article>", "Text"),
    ("<article><p>Text<ol class='x comment-list'><li>A longer comment</ol></article>", "Text"),
    ("<p>Text<section id=comments-section><article><p>A longer comment</article></section>", "Text"),
    ("<div><p>Text</div><div class='site-footer'>Imprint and so on</div>", "Text"),
    ("<p>Text<div id='cookie-banner'><p>We use cookies, agree?</div>", "Text"),
    ("<article><p>Text<div class=share-buttons>Share this on X</div></article>", "Text"),
    ("<article><div class='notice'>This notice is by far longer than the text</div><p>Text</article>", "Text"),
    ("<div class='notice'>This notice is by far longer than the text</div><p>Text", "Text"),
    ("<article><p>Text<p hidden>Not shown<div style='color:red; display: none'>Not shown</div></article>", "Text"),
    ("<article><div class='post-body no-sidebar'><p>Long text</div></article>", "Long text"),
    ("<div class='sidebar-wrapper'><article><p>Long text</article></div>", "Long text"),
    ("a < b and <p>c <b class='x>y' title=\"a 'b'\">d</b>", "a < b and\n\nc d"),
    ("<p>a <b title='open>c</b> d", "a c d"),
    ("<p>1 <div", "1 <div"),
])
def test_html_wrappers_keep_the_article(page, want):
    assert html_text.main_text(html_text.parse(page), set()) == want


@pytest.mark.parametrize("page", ["<div" * 250_000, "<b>" * 300_000 + "x", "a<b " * 250_000, "<a \">\" " * 150_000, "<a '" * 200_001 + ">",
                                  "<p><table>" + "<b>" * 5000 + "<p>x</b>" * 50_000, "</i><i>" * 100_000, "<!-- <" * 100_000, "<![" * 200_000],
                         ids=range(9))
def test_broken_pages_take_linear_time(page):
    start = time.process_time()
    html_text.main_text(html_text.parse(page), set())
    assert time.process_time() - start < 20  # about 1 MB, up to 300,000 elements; a quadratic step takes minutes


@pytest.mark.parametrize("limit", [html_text.BROADCAST_BYTES, 0])
def test_html_templates_of_large_hosts_and_shared_articles(spark, monkeypatch, limit):
    monkeypatch.setattr(html_text, "BROADCAST_BYTES", limit)
    menu = "<div><a href=/1>One</a> <a href=/2>Two</a></div>"
    body = "<div><p>The same article <a href=/x>link</a> on some pages of the host</p><p>Its second paragraph</p></div>"
    rows = [(i, f"http://big.x/{i}", (menu if i < 6 else "") + f"<div>Notice of section {i % 50 if i % 50 < 2 else i}</div>"
             f"<p>Text number {i} of this host</p>") for i in range(200)]
    rows += [(300 + i, f"http://a.x/{i}", f"<article>{body}</article><div>Visit {i}</div>") for i in range(4)]
    rows += [(400 + i, f"http://b.x/{i}", f"{body if i < 4 else f'<p>Page {i}</p>'}<i>{i}</i>") for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert got[0] == "Text number 0 of this host" and got[51] == "Text number 51 of this host"
    assert got[7] == "Notice of section 7\n\nText number 7 of this host"
    same = "The same article link on some pages of the host\n\nIts second paragraph"
    assert got[301] == same and got[402] == same + "\n\n2" and got[405] == "Page 5\n\n5"


def test_urls_edges_and_filter(spark):
    pages = spark.createDataFrame([(1, None), (2, "no scheme"), (3, "http://A.COM/x"), (3, "http://A.COM/x"), (4, "ftp://xcom/y"),
                                   (5, "http://com?q"), (None, "https://b.net/es/")], "page_id long, url string").selectExpr("*", "1 AS rule")
    rules = spark.createDataFrame([("com", "/", "allow"), ("a.com", "/x", "block"), (None, "/", "block")], "host string, path string, verdict string")
    got = sorted((str(r["page_id"]), r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, rules).collect())
    assert got == [("1", "", "", None, "allow"), ("2", "", "", None, "allow"), ("3", "a.com", "/x", "a.com/x", "block"),
                   ("3", "a.com", "/x", "a.com/x", "block"), ("4", "xcom", "/y", None, "allow"), ("5", "com", "", None, "allow"),
                   ("None", "b.net", "/es/", None, "allow")]
    assert urls.judge(pages, rules.limit(0)).filter("verdict = 'allow'").count() == 7 and urls.judge(pages.limit(0), rules).count() == 0


def test_chat_edges(spark):
    turns = [(1, 0, "user", "a ### b: </turn>\n\\s"), (1, 1, "assistant", None), (2, 1, "assistant", "x"), (2, None, None, "y"),
             (None, 0, "we: #<\\", "z"), (3, 0, "user", "d"), (3, 0, "user", "d")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS state")
    rows = {r["conv_id"]: r for r in chat.format_chat(df).select("*", chat.parse(chat.F.col("formatted")).alias("t")).collect()}
    assert [tuple(t) for t in rows[1]["t"]] == [("user", "a ### b: </turn>\n\\s"), ("assistant", "")]
    assert [tuple(t) for t in rows[2]["t"]] == [("", "y"), ("assistant", "x")] and [tuple(t) for t in rows[None]["t"]] == [("we: #<\\", "z")]
    assert {k: r["valid"] for k, r in rows.items()} == {1: True, 2: False, None: False, 3: False}
    assert chat.format_chat(df.limit(0)).count() == 0


def test_chat_query_validates_turn_order(spark):
    rows = QUERIES["op8_chat_format"](spark, SF).select("conv_id", "state", "valid").collect()
    roles = {}
    for r in table(spark, SF, "conversations").orderBy("conv_id", "turn").collect():
        roles.setdefault(r["conv_id"], []).append(r["role"])
    assert [r["valid"] for r in rows if r["conv_id"] == -7] == [True] and len(rows) == len(roles) + 1
    for r in rows:
        order = [x for x in roles.get(r["conv_id"], []) if x != "system"]
        if order and order != ["user", "assistant"] * (len(order) // 2):
            assert not r["valid"]


def test_classifiers_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    lang = QUERIES["op6_language_id"](spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    good = lang.filter("held_out").selectExpr("avg(cast(lang = lang_pred AS double)) AS a").first()["a"]
    toxic = QUERIES["op9_toxicity"](spark, sf).join(table(spark, sf, "labels"), "doc_id").filter("held_out")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in toxic.groupBy("toxic", "predicted").count().collect()}
    assert good > 0.98 and n[1, 1] > 0.85 * (n[1, 1] + n[1, 0]) and n.get((0, 1), 0) < 0.02 * n[0, 0]


def test_grammar_clauses():
    g = toxicity.Grammar()
    plain, aimed = g.clauses("what an idiot")[0], g.clauses("you idiot")[0]
    assert g.clauses("that is not an idiot")[0] < plain < aimed and g.clauses("she said idiot")[0] < plain
    assert g.clauses("kill it")[0] < g.clauses("I will kill you")[0] and g.clauses("") == g.clauses("a nice day") == []
    low, base = g.scores(["", None])
    assert low == base and g.scores(["idiot idiot idiot"])[0] > 0.3 > low
    assert toxicity.fit([]).coefficients == g.coefficients


def test_language_code_lengths_are_probabilities():
    import pyarrow as pa

    data = langid.PAD + b"abracadabra"
    parts = [(k, *np.unique(langid.grams(data, k), return_counts=True)) for k in range(langid.ORDER + 1)]
    counts = pa.table({"lang": ["x"] * sum(len(u) for _, u, _ in parts), "k": pa.array(np.concatenate([[k] * len(u) for k, u, _ in parts]), pa.int32()),
                       "gram": np.concatenate([u for _, u, _ in parts]).astype(np.int64), "n": np.concatenate([n for _, _, n in parts])})
    model = langid.build(counts)
    for context in (b"abra", b"\n\n\n\n", b"zzzz", b"dabr"):
        keys = np.concatenate([langid.grams(context + bytes([c]), langid.ORDER) for c in range(256)])
        total = np.exp2(-langid.known_cost(model, langid.ORDER, keys)[:, 0].astype(float)).sum()
        assert 0.5 < total <= 1.0001  # without exclusion some escape mass is lost, none is gained
