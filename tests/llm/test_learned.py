"""Co-training, language ID and the attention model: held-out results and odd rows."""

import dataclasses
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from blotter.llm import attention_lm as A
from blotter.llm import cotrain
from blotter.llm import zstd_langid as Z
from blotter.llm.segments import byte_bpe

FILE = public_tokenizers.path("byte_bpe_50k.json")
SYLLABLES = {"aa": ["lo", "mi", "tan", "ru"], "bb": ["schk", "ung", "ver", "ze"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n)).capitalize() + "."


def corpus(n=240):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(["aa", "bb"])
        good = rng.random() < 0.7
        text = prose(rng, lang, rng.randint(20, 80))
        rows.append((i, text if good else text.upper().replace(" ", "!! "), lang, f"src{i % 3}", int(good)))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, g, s, "x", "y") for i, t, g, s, _ in corpus()]
    rows += [(None, None, None, None, "x", "y"), (500, "", "aa", None, "x", "y"), (501, "12 34", None, "src1", "x", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, label string, row string")


def test_cotraining_on_held_out_labels(spark, docs):
    truth = {i: q for i, _, _, _, q in corpus()}
    labels = [(i, q) for i, q in truth.items() if i % 4 == 0] + [(0, None), (None, 1), (4, truth[4])]
    views = cotrain.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = docs.select("doc_id", cotrain.judged(docs, views).alias("v")).select("doc_id", "v.*").collect()
    assert len(got) == docs.count()
    held = [r["keep"] == bool(truth[r["doc_id"]]) for r in got if r["doc_id"] in truth and r["doc_id"] % 4]
    assert sum(held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_cotraining_without_labels_keeps_all(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    views = cotrain.train(docs, none)
    assert views == []
    assert docs.select(cotrain.judged(docs, views).alias("v")).where("not v.keep").count() == 0
    assert docs.limit(0).select(cotrain.judged(docs, views).alias("v")).count() == 0


def test_language_on_held_out_texts(docs):
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    learned = Z.learn(docs.where(~fold))
    assert set(learned.content) == {"aa", "bb"}
    got = docs.select("doc_id", "lang", "text", fold.alias("held"), Z.predicted(docs, learned).alias("p")).collect()
    held = [r["p"]["lang_pred"] == r["lang"] for r in got if r["held"] and r["doc_id"] < 500]
    assert sum(held) / len(held) > 0.97
    for r in got:
        assert 0 <= r["p"]["score"] <= 1
        if r["text"] in (None, "", "12 34"):
            assert r["p"]["lang_pred"] == Z.UNKNOWN and not r["p"]["accepted"]


def test_language_with_nothing_learned(docs):
    learned = Z.learn(docs.limit(0))
    rows = docs.select(Z.predicted(docs, learned).alias("p")).collect()
    assert {r["p"]["lang_pred"] for r in rows} == {Z.UNKNOWN}


def test_gradients_of_the_attention_model():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in A.start_weights(11, 4).items()}
    w["u"] = rng.normal(0, 1, w["u"].shape)
    pairs = rng.normal(0, 1, (11, 11))
    ids = rng.integers(0, 11, (3, 9))
    target = rng.integers(0, 11, (3, 9))
    target[1, 5:] = -1
    _, g = A.gradients(w, pairs, ids, ids, target)
    for k in w:
        at = (2, 1) if k == "p" else tuple(rng.integers(0, s) for s in w[k].shape)
        loss = []
        for step in (1e-5, -2e-5):
            w[k][at] += step
            loss.append(A.gradients(w, pairs, ids, ids, target)[0])
        w[k][at] += 1e-5
        assert (loss[0] - loss[1]) / 2e-5 == pytest.approx(g[k][at], abs=1e-6)


def test_later_ids_do_not_change_earlier_scores():
    w = A.start_weights(11, 4)
    w["u"] = np.random.default_rng(1).normal(0, 1, w["u"].shape).astype(np.float32)
    pairs = np.zeros((11, 11), np.float32)
    ids = np.random.default_rng(2).integers(0, 11, (1, 9))
    other = ids.copy()
    other[0, 6:] = 0
    a, b = (A.forward(w, pairs, x, x)["logits"][:6] for x in (ids, other))
    assert np.allclose(a, b, atol=1e-5)


def lines_of(ids):
    return A.Lines.of([np.asarray(x).astype("<u2").tobytes() for x in ids])


def test_each_id_is_scored_once():
    sizes = (0, 1, 15, 16, 17, 28, 29, 40, 2_000)
    inputs_of_all, targets, owner = A._windows(lines_of([np.arange(n) for n in sizes]))
    for i, n in enumerate(sizes):
        mine = owner == i
        own, inputs = targets[mine], inputs_of_all[mine]
        assert np.array_equal(own[own >= 0], [*range(n), A.END])
        # A scored id after the first window has CONTEXT ids before it, and follows its input.
        for k, (before, after) in enumerate(zip(inputs, own)):
            first = np.flatnonzero(after >= 0)[0]
            assert first == (A.CONTEXT if k else 0)
            places = np.flatnonzero((after >= 0) & (after != A.END) & (before != A.END))
            assert np.all(after[places] == before[places] + 1)


def test_scores_and_exact_word_counts(docs):
    rows = docs.select("doc_id", "text").collect()
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold)) + [None]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    counts = {}
    for r in rows:
        if not held(r["doc_id"]):
            for w in tokens(r["text"]):
                counts[w] = counts.get(w, 0) + 1
    total, kinds = sum(counts.values()), len(counts)
    A_FREQUENT, A.FREQUENT_WORDS = A.FREQUENT_WORDS, 5
    try:
        got = {r["doc_id"]: r for r in A.scores(docs, FILE).collect()}
    finally:
        A.FREQUENT_WORDS = A_FREQUENT
    assert len(got) == len(rows)
    for r in rows:
        own, g = tokens(r["text"]), got[r["doc_id"]]
        base = sum(math.log10((counts.get(w, 0) + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        assert (g["held_out"], g["n_tokens"], g["train_tokens"]) == (held(r["doc_id"]), len(own), total)
        assert g["n_known"] == sum(w in counts for w in own)
        assert g["base_score"] == pytest.approx(base)
        assert g["score"] < 0 and math.isfinite(g["score"])
    assert A.scores(docs.limit(0), FILE).count() == 0


def encoded(spark, docs):
    texts = [r["text"] or "" for r in docs.select("text").collect()]
    rows = [(np.frombuffer(i, "<u4").astype("<u2").tobytes(),) for i in byte_bpe(FILE).ids(texts)]
    return spark.createDataFrame(rows, "ids binary")


@pytest.fixture(scope="module")
def model(spark, docs):
    return A.learn(encoded(spark, docs))


def test_shares_of_the_next_id_sum_to_one(docs, model):
    for text in ("lomitan ru", docs.where("length(text) > 20").first()["text"][:12]):
        ids = np.frombuffer(next(byte_bpe(FILE).ids([text])), "<u4").astype(np.int64)
        every = np.arange(A.VOCABULARY)
        inputs = np.tile(np.concatenate([[A.END], ids]), (A.VOCABULARY, 1))
        targets = np.full(inputs.shape, -1)
        targets[:, -1] = every
        p = np.exp(A.log_shares(model, inputs, targets)[:, -1])
        assert p.sum() == pytest.approx(1, abs=1e-3)


def slow_score(model, ids):
    """One id at a time: its window alone, attention by loops, a softmax over all ids."""
    w = {k: v.astype(float) for k, v in model.weights.items()}
    d = w["e"].shape[1]
    line = [A.END, *ids.tolist(), A.END]
    total, step = 0.0, A.WINDOW - A.CONTEXT
    for at in range(1, len(line)):
        start = 0 if at <= A.WINDOW else -(-(at - A.WINDOW) // step) * step
        last = [int(model.kept[i]) for i in line[start:at]]
        x = [w["e"][model.class_of[i]] + w["p"][k] for k, i in enumerate(last)]
        q, k, v = (np.array([r @ w["qkv"][:, j * d : (j + 1) * d] for r in x]) for j in range(3))
        a = np.exp(np.minimum(q[-1] @ k.T * d**-0.5, float(A.PEAK)))
        o = (a / a.sum()) @ v
        z = x[-1] @ w["x"] + o @ w["o"]
        logits = np.maximum(z, 0) @ w["u"] + model.pairs[last[-1]]
        after = int(model.kept[line[at]])
        group = model.class_of[after]
        share = logits[group] - math.log(np.exp(logits).sum())
        share += model.inside[last[-1], after] + model.within[line[at]]
        total += share
    return total / math.log(10)


def test_scores_equal_a_slow_version(docs, model):
    rng = np.random.default_rng(3)
    texts = [r["text"] or "" for r in docs.limit(12).collect()] + ["", "a"]
    ids = [np.frombuffer(i, "<u4").astype(np.int64) for i in byte_bpe(FILE).ids(texts)]
    ids += [rng.integers(0, A.VOCABULARY, n) for n in (15, 16, 17, 28, 29, 77)]
    together = A.score(model, lines_of(ids))
    for own, got in zip(ids, together):
        assert got == pytest.approx(slow_score(model, own), rel=1e-5, abs=1e-4)
        assert A.score(model, lines_of([own]))[0] == pytest.approx(got, rel=1e-6, abs=1e-6)


def test_places_only_looked_back_on_are_not_scored(model, monkeypatch):
    """Scores go over all classes once for each id and end, and for the padding of a last window."""
    places = []
    logits = A._logits
    monkeypatch.setattr(A, "_logits", lambda y, *rest: places.append(len(y)) or logits(y, *rest))
    lines = lines_of([np.arange(n) % 700 for n in (0, 15, 16, 27, 28, 400, 2_000)])
    whole = A.score(model, lines)
    step = A.WINDOW - A.CONTEXT
    assert sum(places) == sum(A.WINDOW + step * max(0, -(-(n + 1 - A.WINDOW) // step)) for n in lines.length)
    inputs, targets, owner = A._windows(lines)
    late = targets[:, 0] < 0
    assert late.any()
    every, some = A.class_shares(model, inputs[late], targets[late]), A.class_shares(model, inputs[late], targets[late], A.CONTEXT)
    assert not every[:, : A.CONTEXT].any() and np.allclose(every[:, A.CONTEXT :], some, atol=1e-5)
    monkeypatch.setattr(A, "SCORED_TOGETHER", 5)
    assert A.score(model, lines) == pytest.approx(whole, rel=1e-6, abs=1e-6)


def test_attention_is_whole_however_large_its_scores(model):
    """Scores beyond the range of 32-bit exponents keep their differences, in learning and in scoring."""
    rng = np.random.default_rng(9)
    ids = rng.integers(0, A.CLASSES, (48, A.WINDOW))
    later = np.triu(np.ones((A.WINDOW, A.WINDOW), bool), 1)
    for scale in (1, 40, 100):
        w = A.start_weights(seed=1)
        w["e"] *= scale
        w["p"] *= scale
        full = {k: v.astype(float) for k, v in w.items()}
        d = w["e"].shape[1]
        x = full["e"][ids] + full["p"]
        q, k, v = np.split(x @ full["qkv"], 3, axis=2)
        s = q @ k.transpose(0, 2, 1) * d**-0.5
        s[:, later] = -np.inf
        assert scale == 1 or s.max() > A.PEAK
        assert scale < 100 or s.max(axis=2).min() < -110
        a = np.exp(s - s.max(axis=2, keepdims=True))
        a /= a.sum(axis=2, keepdims=True)
        y = np.maximum(a @ v @ full["o"] + x @ full["x"], 0).reshape(-1, d)
        found = A._hidden(w, ids)
        assert np.allclose(found["a"], a, atol=2e-3) and np.allclose(found["y"], y, atol=2e-3 * y.max())
        # Classes score by ``y`` alone: what scoring looks up by place gives the same.
        u = rng.normal(0, 1e-3, w["u"].shape).astype(np.float32)
        learned = dataclasses.replace(model, weights=w | {"u": u})
        inputs = rng.integers(0, A.VOCABULARY, (5, A.WINDOW))
        targets = rng.integers(0, A.VOCABULARY, (5, A.WINDOW))
        logits = A.forward(learned.weights, model.pairs, inputs, model.class_of[inputs])["logits"].astype(float)
        shares = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
        own = np.take_along_axis(shares, model.class_of[targets].reshape(-1, 1), 1).reshape(targets.shape)
        for skip in (0, A.CONTEXT):
            assert np.allclose(A.class_shares(learned, inputs, targets, skip), own[:, skip:], atol=1e-3)


def test_exponents_are_cut():
    rng = np.random.default_rng(7)
    y, u = rng.normal(0, 1, (6, 4)).astype(np.float32), rng.normal(0, 1, (4, 9)).astype(np.float32)
    last, at = np.arange(6), np.arange(0, 54, 9)
    for top in (0, 59, 61, 100):
        pairs = np.zeros((6, 9), np.float32)
        pairs[2, 3] = pairs[3, 0] = top
        logits = np.minimum(y @ u + pairs, A.PEAK)
        p, sums, own = A._exponents(y, u, pairs, last, at)
        assert np.allclose(p, np.exp(logits), rtol=1e-4) and np.allclose(sums, np.exp(logits).sum(axis=1), rtol=1e-4)
        assert np.allclose(own, logits[:, 0], atol=1e-4)


def test_steps_are_those_of_adam():
    rng = np.random.default_rng(8)
    class_of = np.arange(A.VOCABULARY) % A.CLASSES
    pairs = rng.normal(-4, 1, (200, A.CLASSES)).astype(np.float32)
    windows = rng.integers(0, 200, (3 * A.BATCH - 5, A.WINDOW + 1))
    windows[::7, 9:] = -1
    steps = A.Steps(A.start_weights(), pairs, class_of)
    steps.take(windows, 1)
    w = {k: v.astype(float) for k, v in A.start_weights().items()}
    mean, square = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    order = np.random.default_rng(1).permutation(len(windows))
    for t, at in enumerate(range(0, len(order), A.BATCH), 1):
        batch = windows[order[at : at + A.BATCH]]
        last, after = np.maximum(batch[:, :-1], 0), batch[:, 1:]
        _, g = A.gradients(w, pairs.astype(float), last, class_of[last], np.where(after >= 0, class_of[after], -1))
        for k in w:
            mean[k] += 0.1 * (g[k] - mean[k])
            square[k] += 0.01 * (g[k] ** 2 - square[k])
            w[k] -= A.RATE * mean[k] / (1 - 0.9**t) / (np.sqrt(square[k] / (1 - 0.99**t)) + 1e-8)
    for k, v in w.items():
        # Steps go by the sign of a gradient: one near 0 may be off by rounding.
        assert np.median(np.abs(steps.w[k] - v)) < 1e-4 and np.abs(steps.w[k] - v).max() < 3 * A.RATE


def test_attention_beats_its_counts_and_the_word_count(spark):
    """Held-out documents: with the attention weights set to zero only the counts of pairs are left."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held_out = A.scores(docs, FILE).where("held_out")
    sums = held_out.agg(F.sum("base_score").alias("base"), F.sum("score").alias("score")).first()
    assert sums["score"] > sums["base"] + 0.01 * abs(sums["base"])
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    learned = A.learn(encoded(spark, docs.where(~held & (F.col("doc_id") % 4 == 0))))
    texts = [r["text"].lower() for r in docs.where(held).limit(200).collect()]
    ids = [np.frombuffer(i, "<u4").astype(np.int64) for i in byte_bpe(FILE).ids(texts)]
    with_attention = A.score(learned, lines_of(ids)).sum()
    learned.weights["u"][:] = 0
    assert with_attention > 0.99 * A.score(learned, lines_of(ids)).sum()


def test_rare_ids_keep_their_own_neighbours(spark):
    """Without attention, shares are the counted ones for every pair of ids, however rare."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 4 * A.KEPT, 50) for _ in range(200)]
    texts += [np.array([5_000, 6_000])] * 3 + [np.array([5_001, 6_001])] * 3
    packed = spark.createDataFrame([(t.astype("<u2").tobytes(),) for t in texts], "ids binary")
    learned, rest = A.learn_all(packed, rounds=(1,))
    assert rest is None
    learned.weights["u"][:] = 0
    pairs, last, single = {}, {}, {}
    for t in texts:
        line = [A.END, *t.tolist(), A.END]
        for x, y in zip(line, line[1:]):
            pairs[x, y], last[x], single[y] = pairs.get((x, y), 0) + 1, last.get(x, 0) + 1, single.get(y, 0) + 1
    total = sum(single.values()) + 0.5 * A.VOCABULARY
    wanted = [*list(pairs)[:500], (5_000, 6_000), (5_000, 6_001), (5_001, 6_000), (5_001, 6_001), (40_000, 6_000), (5_000, 40_000)]
    inputs, targets = np.array(wanted).T
    got = A.log_shares(learned, inputs[:, None], targets[:, None])[:, 0]
    for (x, y), share in zip(wanted, got):
        alone = (single.get(y, 0) + 0.5) / total
        own = (pairs.get((x, y), 0) + A.SMOOTH * alone) / (last.get(x, 0) + A.SMOOTH)
        assert share == pytest.approx(math.log(own), abs=1e-4)


def test_pairs_beyond_the_tables_are_joined(spark, docs, monkeypatch):
    rng = random.Random(2)
    words = [byte_bpe(FILE).coder.decode([i]) for i in range(1_000, 9_000)]
    words = [w for w in words if re.fullmatch(" [a-z]+", w)]
    rows = [(i, "".join(rng.choice(words) for _ in range(60)) * rng.randint(1, 2)) for i in range(120)]
    rare = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id + 1000", "text"))
    got = []
    for room in (A.FREQUENT_PAIRS, 1_000, 0):
        monkeypatch.setattr(A, "FREQUENT_PAIRS", room)
        got.append(sorted((r["doc_id"] or -1, r["n_known"], r["score"]) for r in A.scores(rare, FILE).collect()))
    for some in got[1:]:
        assert [r[:2] for r in some] == [r[:2] for r in got[0]]
        assert [r[2] for r in some] == pytest.approx([r[2] for r in got[0]], rel=1e-4)


def test_counts_of_ids_and_pairs(spark, docs):
    packed = [r["ids"] for r in encoded(spark, docs).collect()]
    kept = np.arange(A.VOCABULARY) % A.KEPT
    ids, pairs = np.zeros(A.VOCABULARY, np.int64), np.zeros(A.KEPT**2, np.int64)
    want, want_pairs = {}, {}
    for line in (np.frombuffer(x, "<u2").astype(int) for x in packed):
        for x, y in zip([A.END, *line], [*line, A.END]):
            want[y] = want.get(y, 0) + 1
            pair = kept[x] * A.KEPT + kept[y]
            want_pairs[pair] = want_pairs.get(pair, 0) + 1
    for some in (packed[:7], packed[7:]):
        A._count_ids(ids, A.Lines.of(some))
        A._count_pairs(pairs, A.Lines.of(some), kept)
    assert {i: ids[i] for i in np.flatnonzero(ids)} == want
    assert {i: pairs[i] for i in np.flatnonzero(pairs)} == want_pairs


def test_each_id_is_learned_once():
    kept = np.arange(A.VOCABULARY)
    for n in (0, 1, 15, 16, 17, 100, 5_000):
        ids = np.arange(n)
        for rounds in ((1,), A.ROUNDS):
            found = [A.spread_windows(lines_of([ids, ids[:3]]), kept, r, rounds) for r in range(len(rounds))]
            seen = np.concatenate([w[:, 1:].ravel() for w in found])
            assert sorted(seen[seen >= 0].tolist()) == sorted([*range(n), A.END, *range(min(n, 3)), A.END])
            for w in np.concatenate(found):
                assert np.all((w[1:] == w[:-1] + 1) | (w[1:] == A.END) | (w[1:] < 0) | (w[:-1] == A.END))


def test_very_long_texts_are_scored_whole(spark):
    rows = [(0, "some words again " * 40_000), (3, "y" * 100_000), (4, None), (5, " \t"), (None, "x"), (None, "x")]
    got = A.scores(spark.createDataFrame(rows, "doc_id long, text string"), FILE).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == 6 and by_id[0]["n_tokens"] == 120_001
    assert by_id[4]["n_tokens"] == by_id[5]["n_tokens"] == 1
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_copies_use_up_no_places_of_the_sample(spark, monkeypatch):
    monkeypatch.setattr(Z, "SAMPLE_TEXTS", 5)
    texts = ["".join(chr(97 + (i * 7 + j * j) % 26) for j in range(9)) for i in range(5)]
    rows = [(t, "aa") for t in texts for _ in range(40)]
    content = Z.learn(spark.createDataFrame(rows, "text string, lang string").repartition(3)).content
    assert sorted(content["aa"].decode().split()) == sorted(set(texts))


def test_texts_without_a_letter(docs):
    learned = Z.learn(docs)
    odd = ["² ½ ①", "Ⅷ ⅷ", "123 ٣٤ _ -", "", None, "\u0301", "一", "a²b"]
    rows = docs.sparkSession.createDataFrame([(t,) for t in odd], "text string")
    got = {r["text"]: r["p"] for r in rows.select("text", Z.predicted(rows, learned).alias("p")).collect()}
    for text in odd[:6]:
        assert (got[text]["lang_pred"], got[text]["score"], got[text]["accepted"]) == (Z.UNKNOWN, 0.0, False)
    assert got["一"]["lang_pred"] != Z.UNKNOWN and got["a²b"]["lang_pred"] != Z.UNKNOWN
    assert Z.letters("Straße, Ünï² x\u0301y 12") == "straße ünï x y"


def test_sizes_equal_plain_compression(spark):
    """Each block by a compressor of its own, without prepared dictionaries."""
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = Z.learn(docs)
    assert all(0 < len(c) <= Z.DICTIONARY_BYTES for c in learned.content.values())
    rows = docs.union(spark.createDataFrame([(-1, "Ein langer Text, " * 20_000, None, None, None)], docs.schema))
    for r in rows.select("text", Z.predicted(docs, learned).alias("p")).collect():
        if not Z.letters(r["text"]):
            continue
        data = f" {Z.letters(r['text'])} ".encode()
        sizes = {}
        for lang, content in learned.content.items():
            options = zstandard.ZstdCompressionParameters.from_level(
                Z.LEVEL, source_size=Z.BLOCK_BYTES, dict_size=len(content), write_content_size=0, write_checksum=0
            )
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            sizes[lang] = sum(
                len(zstandard.ZstdCompressor(dict_data=raw, compression_params=options).compress(data[i : i + Z.BLOCK_BYTES]))
                for i in range(0, len(data), Z.BLOCK_BYTES)
            )
        first, second = sorted(sizes.values())[:2]
        assert abs(sizes[r["p"]["lang_pred"]] - first) <= 2 * (1 + len(data) // Z.BLOCK_BYTES)
        if second - first > 4 * (1 + len(data) // Z.BLOCK_BYTES):
            assert sizes[r["p"]["lang_pred"]] == first and r["p"]["accepted"]


def test_margin_is_a_share_of_the_size():
    wide, narrow = Z.Dictionaries({"a": b"x" * 20, "b": b"y" * 20}, 0.5), Z.Dictionaries({"a": b"x" * 20, "b": b"y" * 20})
    assert Z.judge([100, 120, 300])[2:] == (20, 100)
    assert Z.judge([100]) == (0, 1.0, 100, 100)
    assert (wide.margin, narrow.margin) == (0.5, 0.0)


def test_sample_is_the_smallest_hashes(spark, monkeypatch):
    """Many copies of few texts: the bound on hashes is raised until the places are filled."""
    monkeypatch.setattr(Z, "SAMPLE_TEXTS", 6)
    rows = [(f"text {'abcdefgh'[i % 8]} of some letters", "en") for i in range(4_000)] + [("un texte", "fr"), (None, "fr"), ("x", None)]
    learned = Z.learn(spark.createDataFrame(rows, "text string, lang string").repartition(5))
    assert list(learned.content) == ["en", "fr"]
    assert learned.content["en"].count(b"some letters") == 6
    assert learned.content["fr"] == b"un texte"


def test_a_column_of_another_type_is_refused(spark):
    with pytest.raises(TypeError):
        Z.predicted(spark.createDataFrame([(1,)], "text int"), Z.Dictionaries({}))
