"""Multi-index search, URL filter, tool calls and the SentencePiece codec."""

import json
import math
import random

import numpy as np
import public_tokenizers
import sentencepiece

from blotter.llm import multi_index as M
from blotter.llm import piece_codec as C
from blotter.llm import tool_calls as T
from blotter.llm import url_filter as U

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def vectors(n=600, d=8, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 4, (12, d))
    return [(i, (centres[i % 12] + rng.normal(0, 1, d)).tolist()) for i in range(n)]


def nearest(rows, every, k):
    out = {}
    for q, v in rows:
        if q % every == 0:
            far = sorted((math.dist(v, w), i) for i, w in rows if i != q)
            out[q] = far[:k]
    return out


def test_search_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 64)
    rows = vectors()
    bad = [(1001, None), (1002, [0.0] * 8), (1003, [float("nan")] * 8), (1004, [None] + [1.0] * 7), (1005, [1.0]), (None, [1.0] * 8)]
    frame = spark.createDataFrame([(*r, "x") for r in rows + bad], "vec_id long, embedding array<double>, cell string")
    expected = nearest(rows, 10, 10)
    found = {}
    for r in M.search(frame, every=10).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == set(expected)
    by_id = dict(rows)
    hits = 0
    for q, got in found.items():
        got.sort()
        assert [g[0] for g in got] == list(range(1, 11))
        assert [(g[2], g[1]) for g in got] == sorted((g[2], g[1]) for g in got)
        for _, i, score in got:
            assert math.isclose(score, math.dist(by_id[q], by_id[i]), rel_tol=1e-12)
        hits += len({g[1] for g in got} & {i for _, i in expected[q]})
    assert hits >= 0.9 * 10 * len(expected)


def test_small_tables_give_all_there_is(spark):
    rng = np.random.default_rng(4)
    for n in (2, 3, 11, 15, 25):
        rows = [(i, rng.normal(size=8).tolist()) for i in range(n)]
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = M.search(frame, every=100).collect()
        assert sorted(r["rank"] for r in got) == [*range(1, min(10, n - 1) + 1)]
        assert len({r["vec_id"] for r in got}) == len(got)


def test_search_ties_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(0, 300, 3)] * 2, schema)
    got = M.search(same, every=100).collect()
    mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 0)
    assert mine == [(i, 3 * i) for i in range(1, 11)]
    assert M.search(same.where("vec_id = 0"), every=100).count() == 0
    assert M.search(same.limit(0)).count() == 0


URLS = [
    None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "HTTP://WWW.Example.NET/en/1", "http://x.example.net/en",
    "http://example.com/de/x?y", "http://notexample.com/de/", "https://a.org/fr/?q", "https://a.org#x", "http://net/?a://b/c",
    "http://cheap-pills.org/x?b=2&a=1&utm_source=z#t", "http://www.cheap-pills.org/x/?ref=9&a=1&b=2", "http://pillsbury.org/x", "a://Ä.net/\n/x",
]


def test_url_verdicts(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS + ["http://cheap-pills.org/x?a=1&b=2"] * 30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, key string, listed string")
    got = {r["page_id"]: r for r in U.judge(pages, U.listed_urls(pages)).collect()}
    assert len(got) == len(rows)
    by_url = {u: got[i] for i, u in enumerate(URLS)}
    expected = {
        None: ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://a.net": ("a.net", "", None, "allow"),
        "http://a.net/": ("a.net", "/", "net/", "block"),
        "HTTP://WWW.Example.NET/en/1": ("www.example.net", "/en/1", "example.net/en/", "allow"),
        "http://x.example.net/en": ("x.example.net", "/en", "net/", "block"),
        "http://example.com/de/x?y": ("example.com", "/de/x", "example.com/de/", "block"),
        "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "https://a.org/fr/?q": ("a.org", "/fr/", "org/fr/", "allow"),
        "http://net/?a://b/c": ("net", "/", "net/", "block"),
        "http://cheap-pills.org/x?b=2&a=1&utm_source=z#t": ("cheap-pills.org", "/x", None, "block"),
        "http://www.cheap-pills.org/x/?ref=9&a=1&b=2": ("www.cheap-pills.org", "/x/", None, "block"),
        "http://pillsbury.org/x": ("pillsbury.org", "/x", None, "allow"),
        "a://Ä.net/\n/x": ("Ä.net", "/\n/x", "net/", "block"),
    }
    for url, want in expected.items():
        r = by_url[url]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == want, url
    assert U.judge(pages.limit(0), U.listed_urls(pages.limit(0))).count() == 0


def test_full_filter_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(U, "MOST_BLOCKS", 1)
    keys = spark.createDataFrame([(f"k{i}",) for i in range(300)], "key string")
    rows = spark.createDataFrame([(i, f"k{i}") for i in range(0, 900, 3)], "page_id long, key string")
    got = {r["page_id"]: r["listed"] for r in U.in_list(rows, keys).collect()}
    assert got == {i: i < 300 for i in range(0, 900, 3)}


CALLS = "conv_id long, turn long, call_id string, name string, arguments string, waits_for array<string>, level int"
RESULTS = "conv_id long, turn long, call_id string, content string, r string"
GOOD = json.dumps({"words": 9, "prompt": "p" * 20, "depth": 1})


def test_tool_calls(spark):
    calls = [
        (1, 0, "a", "reply", GOOD, ["c", "b", "none"], 1),
        (1, 1, "b", "reply", GOOD, ["c"], 1),
        (1, 2, "c", "configure", '{"strict": "no", "x": 1}', None, 1),
        (1, 3, "d", "reply", "[1]", ["d"], 1),
        (1, 4, "e", "nothing", None, [], 1),
        (1, 5, "f", "reply", '{"words": 2, "prompt": "short", "z": null}', [], 1),
        (1, 6, "g", "reply", GOOD, [], 1),
        (1, 7, "g", "reply", GOOD, [], 1),
        (1, 8, "h", "reply", GOOD, [], 1),
        (1, 8, "h", "reply", GOOD, [], 1),
        (1, 9, None, "reply", GOOD, ["a"], 1),
    ]
    results = [(1, 1, "a", "é\n", "x"), (1, 5, "a", "later", "x"), (1, 2, "zz", "lost", "x"), (1, 3, None, None, "x"), (1, 2, "c", "ok", "x")]
    rows = T.link(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS)).collect()
    by = {(r["call_id"], r["turn"]): r for r in rows}
    assert len(rows) == 9 + 2
    assert [by[k]["level"] for k in (("c", 2), ("b", 1), ("a", 0), ("d", 3))] == [0, 1, 2, None]
    assert by["a", 0]["status"] == "ok" and by["a", 0]["n_results"] == 2
    assert by["a", 0]["json"] == '{"arguments":{"depth":1,"prompt":"' + "p" * 20 + '","words":9},"id":"a","name":"reply","result":"é\\n"}'
    assert by["b", 1]["status"] == "unanswered"
    assert by["c", 2]["errors"] == ["instruction: missing", "strict: type", "x: unknown"]
    assert by["d", 3]["status"] == "circular" and by["d", 3]["errors"] == ["arguments are no object"]
    assert by["e", 4]["errors"] == ["unknown tool"]
    assert by["f", 5]["errors"] == ["prompt: too small", "words: too small", "z: unknown"]
    assert by["g", 6]["status"] == "duplicate id" and by["h", 8]["status"] == "unanswered"
    assert by[None, 9]["status"] == "unanswered" and by["zz", 2]["status"] == "orphan result"
    for r in rows:
        if r["json"]:
            json.loads(r["json"])
    none = T.link(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS))
    assert none.count() == 0


ODD = [None, "", " ", "a  b", " lead", "tail ", "x\ty\nz", "日本語 𝄞 é", "▁mark ▁", "<s> </s> <0x0A>", "a\u00a0b", "a\x00b", "ñ" * 300, "don't 12 !"]


def test_codec_agrees_with_sentencepiece(spark):
    rng = random.Random(2)
    texts = ODD + [" ".join("".join(rng.choices("abcdefghé", k=rng.randint(1, 9))) for _ in range(200)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    judge = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoded = C.decode(C.encode(docs, PIECES), PIECES).collect()
    for r in encoded:
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == judge.encode(text) and r["parity"]
        assert r["decoded"] == judge.decode(r["ids"])
    trips = C.round_trip(docs, PIECES).collect()
    assert all(r["parity"] and r["round_trip"] == ("▁" not in (texts[r["doc_id"]] or "")) for r in trips)
    assert C.round_trip(docs.limit(0), PIECES).count() == 0


def test_unigram_models_are_rebuilt():
    model = C.Model(
        ["<unk>", "▁", "▁a", "b", "▁ab", "c"], [0.0, -3.0, -2.0, -2.5, -3.0, -4.0],
        [C.UNKNOWN, C.NORMAL, C.NORMAL, C.NORMAL, C.NORMAL, C.NORMAL], C.UNIGRAM,
    )
    coder = C.rebuild(model)
    assert coder.encode("ab  c", add_special_tokens=False).ids == [4, 1, 5]
    assert coder.decode([4, 1, 5]) == "ab c"


def test_recall_on_the_given_table(spark):
    """Every tenth vector as a query against brute force over the whole table."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in M.search(table, every=10).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    rows = M.usable(table).collect()
    ids, v = np.array([r["vec_id"] for r in rows]), np.array([r["v"] for r in rows])
    found = wanted = 0
    for q in ids[ids % 10 == 0]:
        far = ((v - v[ids == q][0]) ** 2).sum(axis=1)
        near = [i for i in ids[np.lexsort((ids, far))].tolist() if i != q][:10]
        found, wanted = found + len(got[q].intersection(near)), wanted + len(near)
    assert len(got) == np.count_nonzero(ids % 10 == 0)
    assert found >= 0.9 * wanted
