"""SimHash groups against all pairs."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from blotter.llm import simhash as S
from blotter.llm.components import connected_components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    names = sorted(fps)
    root = {d: d for d in names}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in names}


def test_masks_cover_every_pair_of_positions():
    first = S.covering_masks(list(range(64)))
    for i in range(64):
        for j in range(i, 64):
            free = [m for m in first if not m >> i & 1 and not m >> j & 1]
            assert free
            for m in free:
                second = S.covering_masks(S._dropped(m))
                assert any(not x >> i & 1 and not x >> j & 1 for x in second)
    for m in first:
        for x in S.covering_masks(S._dropped(m)):
            assert len(S._dropped(m)) - x.bit_count() <= 12


def test_fingerprint_of_odd_texts():
    for t in (None, "", " \t", "One", "a b", "A b C", "a b c d", "ß Ä é " * 40, "x\x1cy z\x0bw", "  a b c"):
        assert S.simhash(t) == plain(t)


def test_groups_equal_those_of_all_pairs(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    texts = [None, "", "  ", "solo"]
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(40, 200))
        for _ in range(6):
            own = list(base)
            own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
        texts += [" ".join(base), " ".join(base).upper()]
    rows = [(i * 7 % 1009, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, fp string")
    expected = components({d: plain(t) for d, t, _ in rows})
    for bucket in (512, 1):
        monkeypatch.setattr(S, "BUCKET", bucket)
        got = S.near_duplicates(docs).collect()
        assert len(got) == len(rows) + 2
        for r in got:
            assert r["component_id"] == expected[r["doc_id"]]
    by_id = {d: t for d, t, _ in rows}
    assert all(int(r["fingerprint"], 16) == plain(by_id[r["doc_id"]]) for r in got)
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_dense_close_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKET", 8)
    base = 0x0123456789ABCDEF
    near = {base ^ (1 << i) ^ (1 << j) for i in range(0, 64, 7) for j in range(64)}
    far = {base ^ 0xFF00FF00FF00FF ^ (1 << i) for i in range(5)}
    fps = [S._signed(x) for x in near | far]
    edges = S.linked_fingerprints(spark.createDataFrame([(x,) for x in fps], "fp long"))
    roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    expected = components(dict(zip(fps, [x & (1 << 64) - 1 for x in fps])))
    assert {k: v for k, v in roots.items()} == {k: v for k, v in expected.items() if list(expected.values()).count(v) > 1}


def test_long_chain_is_one_component(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(8)
    words = [f"v{i}" for i in range(3_000)]
    texts = [None, "", " \t", None]
    for _ in range(15):
        base = rng.choices(words, k=400)
        close, apart = list(base), list(base)
        close[399] = "changed"
        for i in range(0, 400, 9):
            apart[i] = "other"
        texts += [base, close, base, apart]
    rows = [(i * 7 % 101, t if isinstance(t, str | None) else " ".join(t), "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    groups = components({d: plain(t) for d, t, _ in rows})
    got = S.without_near_copies(docs)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(groups.values()))
    assert len(set(groups.values())) < 50
    assert S.without_near_copies(docs.limit(0)).count() == 0


def test_near_copies_with_odd_ids_and_names(spark):
    """Null ids, repeated ids and rows, and columns named like ours."""
    long = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    rows = [
        (None, long[0], 1),
        (5, long[0], 2),
        (None, long[1], 3),
        (7, long[2], 4),
        (7, long[2], 4),
        (7, long[3], 5),
        *[(9, long[3], 6)] * 40,
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long").withColumns(
        {"_row": F.lit(0), "ROW_": F.lit(0), "first": F.lit(0), "fp": F.lit("x"), "component_id": F.lit(1)}
    )
    got = S.without_near_copies(docs.repartition(3))
    assert got.columns == docs.columns
    found = sorted(((r["doc_id"] or 0), r["row"]) for r in got.collect())
    assert found == [(0, 3), (5, 2), (7, 4), (7, 5)]


def test_very_long_texts():
    words = [f"w{i % 977}" for i in range(300_000)]
    assert S.simhash(" ".join(words)) == plain(" ".join(words))
    assert S.simhash("y" * 100_000) == xxhash.xxh64_intdigest("y" * 100_000, 42)
