"""Alignment of two tokenizers' tokens against a plain version."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from blotter.llm import token_alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")

ODD = [
    None,
    "",
    " ",
    "\n",
    "word",
    " two  blanks \n\n and\tlines\n",
    "<|endoftext|> <s> </s> <unk> <0x0A> is plain text",
    "a mark ▁ is no blank",
    "▁",
    "café naïve ﬁ ① ² 東京 😀👩‍👩‍👧 é",
    "no break　wide\r\nnext\x0b\x0c\x1c\x85end",
    "it's 12345 $$$ %%% don't!!!",
    "trailing   ",
    "​ zero\x00null",
    "same same same same",
    "same same same same",
    "x" * 5000,
    ("ab" * 1500) + " " + "-" * 3000 + " " * 2500 + "z",
]


def plain(texts):
    """One document at a time, whole texts, Python loops."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {chr(c): c for c in (*range(33, 127), *range(161, 173), *range(174, 256))}
    rest = [c for c in range(256) if c not in letters.values()]
    letters |= {chr(256 + i): c for i, c in enumerate(rest)}

    def cut(text):
        if not text:
            return []
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return []
        groups, x, y, upto_a, upto_b = [([], [])], 0, 0, 0, 0
        while x < len(ids_a) or y < len(ids_b):
            if upto_a == upto_b and groups[-1][0]:
                groups.append(([], []))
            if upto_a <= upto_b:
                groups[-1][0].append(ids_a[x])
                upto_a += len(bytes_a[x])
                x += 1
            else:
                groups[-1][1].append(ids_b[y])
                upto_b += len(bytes_b[y])
                y += 1
        return groups

    every = [cut(t) for t in texts]
    linked = [Counter((i, j) for g in groups for i in g[0] for j in g[1]) for groups in every]
    n = Counter(pair for own in linked for pair in own)
    best = defaultdict(int)
    for (i, _), count in n.items():
        best[i] = max(best[i], count)
    rows = []
    for k, (groups, own) in enumerate(zip(every, linked)):
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append(
            (
                k,
                sum(len(x) for x, _ in groups),
                sum(len(y) for _, y in groups),
                len(groups),
                sum(own.values()),
                sum(t for p, t in own.items() if n[p] == best[p[0]]),
                sum(t * n[p] for p, t in own.items()),
                hashlib.sha256(spelled.encode()).hexdigest() if groups else "",
            )
        )
    return rows


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: (r[0] is None, r[0]))


@pytest.fixture(scope="module")
def given(spark):
    prose = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    return ODD + prose


@pytest.mark.parametrize("looked_up", [token_alignment.LOOKED_UP, 300, 0])
def test_equals_plain_version(spark, given, looked_up):
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(given)], "doc_id bigint, text string, pairs int")
    found = token_alignment.align(docs.repartition(3), A, B, looked_up=looked_up)
    assert found.columns == COLUMNS
    assert rows_of(found) == plain(given)


def test_forgetting_changes_nothing(spark, given, monkeypatch):
    monkeypatch.setattr(token_alignment, "REMEMBERED", 50)
    ours = token_alignment.Aligner(A, B)
    whole = [x for k in range(0, len(given), 7) for x in ours.documents(given[k : k + 7])]
    for row, x in zip(plain(given), whole):
        assert (row[1:5], row[7]) == (((0, 0, 0, 0), "") if x is None else (tuple(x[0]), x[1]))


def test_group_breaks():
    group_a, group_b = token_alignment.coalesced(np.array([2, 5, 6]), np.array([1, 2, 3, 6]))
    assert group_a.tolist() == [0, 1, 1]
    assert group_b.tolist() == [0, 0, 1, 1]


def test_empty_table_null_ids_and_repeated_rows(spark):
    kind = "doc_id bigint, text string"
    assert token_alignment.align(spark.createDataFrame([], kind), A, B).count() == 0
    twice = spark.createDataFrame([(None, "one word"), (None, "one word"), (3, None)], kind)
    rows = rows_of(token_alignment.align(twice, A, B))
    assert rows[0] == (3, 0, 0, 0, 0, 0, 0, "")
    assert rows[1] == rows[2] and rows[1][5:7] == (rows[1][4], 2 * rows[1][4])


def test_very_long_texts(spark):
    long = "Some words, again. " * 60_000 + "y" * 100_000
    docs = spark.createDataFrame([(1, long)], "doc_id bigint, text string")
    row = token_alignment.align(docs, A, B).first()
    assert row["n_groups"] > 240_000 and row["n_best"] <= row["n_links"]
