"""Packing: pieces against the tokenizer, plans against totals and best fit."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from blotter.llm import packing as P
from blotter.llm.segments import byte_bpe

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a  b", " lead", "tail ", "x\ty\n z", "日本語 𝄞 é", "<|endoftext|> a", "don't 12 ...", "a b", "\n\n", "é" * 50]


def test_ids_are_those_of_tokenizers():
    reference = Tokenizer.from_file(FILE).encode_batch(ODD, add_special_tokens=False)
    ours = [np.frombuffer(x, "<u4").tolist() for x in byte_bpe(FILE).ids(ODD)]
    assert ours == [r.ids for r in reference]


@pytest.mark.parametrize("seed,groups", [(0, 8), (1, 32), (2, 96)])
def test_plan_places_every_length_within_few_sequences(seed, groups):
    rng = random.Random(seed)
    counts = dict(collections.Counter(rng.randint(1, 128) for _ in range(5_000)))
    plan = P.packed(counts, 128, groups)
    placed = collections.Counter()
    for n, lengths in plan:
        assert sum(lengths) <= 128
        for x in lengths:
            placed[x] += n
    assert dict(placed) == counts
    bound = -(-sum(k * v for k, v in counts.items()) // 128)
    assert sum(n for n, _ in plan) <= 1.03 * bound
    taken = collections.Counter()
    for length, lo, hi, _, _ in P._places(plan):
        assert lo == taken[length]
        taken[length] = hi
    assert dict(taken) == counts


def test_lengths_that_only_pair_one_way():
    counts = {70: 100, 58: 100, 64: 51}
    assert sum(n for n, _ in P.packed(counts, 128)) == 126


def test_rows_are_packed_without_gaps(spark):
    rng = random.Random(5)
    texts = [None, "", " ", "same text", "same text", "word " * 3_000] + [
        " ".join(rng.choices(["alpha", "beta", "gamma é"], k=rng.randint(1, 400))) for _ in range(60)
    ]
    rows = [(i if i != 7 else None, t, "x", 1, 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, share int, rank int")
    got = P.pack(docs, FILE).collect()
    coder = Tokenizer.from_file(FILE)
    by_doc = collections.defaultdict(list)
    by_sequence = collections.defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == {r[0] for r in rows}
    for doc_id, text, *_ in rows:
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        pieces = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert sum(p["length"] for p in pieces) == len(ids)
        assert all(p["length"] == 1024 for p in pieces[1:])
        for p in pieces:
            part = ids[p["start"] : p["start"] + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(part.tobytes())
    for rows_ in by_sequence.values():
        at = 0
        for r in sorted(rows_, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert P.pack(docs.limit(0), FILE).count() == 0
