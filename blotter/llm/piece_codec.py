"""SentencePiece models on the ``tokenizers`` library.

The model file is a protobuf; its wire format is read here. From it come the
normaliser, the mark for blanks, the scores (unigram) or the merges they imply
(BPE) and byte fallback. If no piece holds a mark behind another character,
ids of a text are those of its marked words, and each distinct word is encoded
once per task, many at a time and on several threads. Every such word is also
encoded by the ``sentencepiece`` library, and the two must agree.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import only
from blotter.llm.segments import SegmentTable, grouped, packed

MARK = "▁"
#: Piece types of the protobuf; fixed values.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Threads of the second library; ``tokenizers`` takes as many as it finds.
THREADS = 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = varint()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """What a model file says; see ``read_model``."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_blanks: bool = True

    @cached_property
    def word_by_word(self) -> bool:
        """No piece goes on across the start of a marked word."""
        return not any(re.search(f"[^{MARK}]{MARK}", p) for p, t in zip(self.pieces, self.types) if t in (NORMAL, USER_DEFINED))


def read_model(path: str) -> Model:
    with open(path, "rb") as f:
        data = f.read()
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            model.pieces.append(own[1].decode())
            model.scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            model.types.append(own.get(3, NORMAL))
        elif number == 2:
            spec = dict(_fields(value))
            model.kind, model.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap = spec.get(2, b"")
            model.dummy_prefix, model.squeeze_blanks = bool(spec.get(3, 1)), bool(spec.get(4, 1))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be rebuilt")
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """All pairs of pieces that join to a piece, the best joined score first."""
    usable = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t in (NORMAL, USER_DEFINED)}
    found = []
    for piece, i in usable.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in usable and right in usable:
                found.append((-model.scores[i], i, usable[left], usable[right], left, right))
    return [(m[4], m[5]) for m in sorted(found)]


def rebuild(model: Model):
    """A ``tokenizers.Tokenizer`` with normaliser, model and decoder."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unknown = model.types.index(UNKNOWN) if UNKNOWN in model.types else None
    if model.kind == UNIGRAM:
        core = models.Unigram(list(zip(model.pieces, model.scores)), unknown, model.byte_fallback)
    else:
        core = models.BPE(
            {p: i for i, p in enumerate(model.pieces)},
            merges(model),
            unk_token=None if unknown is None else model.pieces[unknown],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze_blanks:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else [])
    )
    return tokenizer


class Codec:
    """Encodes and decodes; ``bad`` holds words that the two libraries disagree on."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = read_model(path)
        self.whole = rebuild(self.model)
        self.plain = not self.model.charsmap and not self.model.squeeze_blanks and self.model.dummy_prefix
        self.marked = rebuild(self.model)
        self.marked.normalizer = None
        self.judge = sentencepiece.SentencePieceProcessor(model_file=path)
        self.table = SegmentTable(self._both_marked)
        self.bad: set[str] = set()

    def _both_marked(self, words: list[str]) -> list[bytes]:
        """As ``_both`` for single words, whose normal form is known beforehand."""
        return self._both(words, self.marked, [MARK + w for w in words])

    def _both(self, texts: list[str], coder=None, given: list[str] | None = None) -> list[bytes]:
        """Ids by ``tokenizers``; texts that ``sentencepiece`` cuts otherwise are noted."""
        coder = coder or self.whole
        ours = [e.ids for e in coder.encode_batch_fast(given or texts, add_special_tokens=False)]
        theirs = self.judge.encode(texts, num_threads=THREADS)
        if ours != theirs:
            self.bad.update(t for t, a, b in zip(texts, ours, theirs) if a != b)
        return [packed(ids) for ids in ours]

    def _words(self, text: str | None) -> list[str] | None:
        """Words that the dummy prefix gives their mark, or None: encode whole."""
        if not text:
            return []
        if not (self.plain and self.model.word_by_word) or MARK in text:
            return None
        words = text.split(" ")
        return None if "" in words else words

    def encode(self, texts: Iterable[str | None]) -> Iterator[tuple[bytes, bool]]:
        """(ids as little-endian unsigned 32-bit bytes, whether the libraries agree)."""
        for some in grouped(texts):
            words = [self._words(t) for t in some]
            self.table.learn(words)
            for text, own in zip(some, words):
                ids = self._both([text])[0] if own is None else self.table.join(own)
                yield ids, not self.bad or self.bad.isdisjoint([text] if own is None else own)

    @cached_property
    def _bytes(self) -> list[bytes]:
        return [
            bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(MARK, " ").encode()
            for p, t in zip(self.model.pieces, self.model.types)
        ]

    def decode(self, encoded: Iterable[bytes]) -> Iterator[str]:
        """Texts of ids; ids whose bytes are no UTF-8 go through the library's decoder."""
        for packed_ids in encoded:
            ids = memoryview(packed_ids).cast("I").tolist()
            try:
                text = b"".join(map(self._bytes.__getitem__, ids)).decode()
                yield text[1:] if self.model.dummy_prefix and text.startswith(" ") else text
            except UnicodeDecodeError:
                yield self.whole.decode(ids, skip_special_tokens=False)


@lru_cache(maxsize=2)
def codec_of(path: str) -> Codec:
    """The codec of this Python process: what it has learned outlives a task."""
    return Codec(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int), ``parity``; null and empty texts have none."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(model)
        for batch in batches:
            found = list(codec.encode(batch["text"]))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "ids": [np.frombuffer(ids, "<u4").astype(np.int32) for ids, _ in found],
                    "parity": [same for _, same in found],
                }
            )

    source = only(docs, doc_id=id_col, text=text_col)
    return source.mapInPandas(
        rows,
        T.StructType(
            [source.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("parity", T.BooleanType())]
        ),
    )


def decode(rows: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of their ids; null ids give null."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = codec_of(model)
        for batch in batches:
            given = [b"" if x is None else np.asarray(x, "<u4").tobytes() for x in batch]
            yield pd.Series([None if x is None else t for x, t in zip(batch, codec.decode(given))], dtype=object)

    return rows.withColumn("decoded", text(F.col(f"`{ids_col}`")))


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_ids``, ``ids_crc32``, ``round_trip``, ``parity`` per row.

    ``ids_crc32`` is over unsigned little-endian 32-bit ids; ``round_trip``
    says that decoding gives the text back, ``parity`` that both libraries
    agree. Null and empty texts have no ids and pass both; repeated rows are
    reported each; an empty table gives an empty one.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(model)
        for batch in batches:
            found = list(codec.encode(batch["text"]))
            back = codec.decode(ids for ids, _ in found)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_ids": [len(ids) // 4 for ids, _ in found],
                    "ids_crc32": [zlib.crc32(ids) for ids, _ in found],
                    "round_trip": [(t or "") == b for t, b in zip(batch["text"], back)],
                    "parity": [same for _, same in found],
                }
            )

    source = only(docs, doc_id=id_col, text=text_col)
    return source.mapInPandas(
        rows,
        T.StructType(
            [
                source.schema["doc_id"],
                T.StructField("n_ids", T.LongType()),
                T.StructField("ids_crc32", T.LongType()),
                T.StructField("round_trip", T.BooleanType()),
                T.StructField("parity", T.BooleanType()),
            ]
        ),
    )
