"""Winnowing against a plain version, on hand-made and odd texts."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from blotter.llm import winnowing as W


def plain(spark, text):
    """(hash, position) by trying every window; hashes come from Spark."""
    n = len(text)
    if not n:
        return []
    grams = [text[i : i + W.K] for i in range(max(1, n - W.K + 1))]
    rows = spark.createDataFrame(list(enumerate(grams)), "i int, g string")
    mask = ~((1 << W.PLACE_BITS) - 1)
    hashed = rows.select("i", F.shiftright(F.xxhash64(F.encode("g", "UTF-32")).bitwiseAND(F.lit(mask)), W.PLACE_BITS).alias("h"))
    h = [r["h"] for r in hashed.orderBy("i").collect()]
    kept = set()
    for s in range(max(1, len(h) - W.W + 1)):
        window = h[s : s + W.W]
        least = min(window)
        place = s + max(i for i, x in enumerate(window) if x == least)
        kept.add((least, place))
    return sorted(kept, key=lambda x: x[1])


def made(seed, n, letters="abcde é𝄞"):
    return "".join(random.Random(seed).choices(letters, k=n))


TEXTS = ["", "a", "short text", "x" * 100, "ab" * 90, made(1, 43), made(2, 44), made(3, 400), "日本語の文章" * 30]


def test_kept_hashes_are_those_of_every_window(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 64)
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    got = W.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        assert [(x["hash"], x["position"]) for x in r["kept"]] == plain(spark, TEXTS[r["doc_id"]])


def test_shared_passage_shares_a_hash(spark):
    passage = made(9, W.K + W.W - 1, "qrstuv")
    rows = [(1, made(4, 200) + passage + made(5, 100)), (2, made(6, 77) + passage + made(7, 300))]
    a, b = [{x["hash"] for x in r["kept"]} for r in W.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert a & b


def test_edited_texts_and_likeness(spark):
    texts = {7: TEXTS[7], 3: None, 12: TEXTS[8], 5: "one two three", 40: TEXTS[7], 41: made(11, 150), 2: made(8, 90)}
    docs = spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "doc_id long, text string, kept string")
    got = {r["doc_id"]: r for r in W.compared(docs, ranges=3).collect()}
    order = sorted(texts, reverse=True)
    assert set(got) == set(order)
    assert got[7]["fingerprint"] == got[40]["fingerprint"] != got[41]["fingerprint"]
    for i, d in enumerate(order):
        own, after = texts[d] or "", texts[order[(i + 1) % len(order)]] or ""
        m = len(own) // 2
        edited = own[: len(own) - m] + after[:m]
        r = got[d]
        assert r["n_chars"] == len(own)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        sets = [{h for h, _ in plain(spark, t)} for t in (own, edited, after)]
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        assert r["near_edited"] == pytest.approx(like(sets[0], sets[1]))
        assert r["near_next"] == pytest.approx(like(sets[0], sets[2]))


def test_repeated_null_and_missing_rows(spark):
    docs = spark.createDataFrame([(1, "abc"), (1, "abc"), (None, "x"), (None, None)], "doc_id long, text string")
    assert W.compared(docs).count() == 4
    assert W.compared(docs.limit(0)).count() == 0
    one = W.compared(docs.limit(1)).first()
    assert one["near_next"] == 1.0
