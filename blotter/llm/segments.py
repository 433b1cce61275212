"""Subword ids of many texts.

Where a tokenizer always cuts before a blank, a text's ids are those of its
segments one after another. Prose repeats its words, so a table
of segments already seen saves most of the tokenizer's work. The table is
local to a Python worker, is emptied when full, and never changes an id.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

#: Segments that a Python worker remembers before it starts anew.
REMEMBERED = 600_000
#: Texts whose new segments are encoded together.
TOGETHER = 512


# Fixed values of byte-level BPE: how it parts a text into words, and which
# bytes stand for themselves in the vocabulary file.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTED = (*range(33, 127), *range(161, 173), *range(174, 256))


def _bytes_by_letter() -> dict[str, int]:
    """The byte behind each letter of the file; unprinted bytes follow from 256 on."""
    others = [b for b in range(256) if b not in PRINTED]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}


class SegmentTable:
    """Ids of segments, learned in batches; ``encode`` does many at once."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]]):
        self.encode = encode
        self.known: dict[str, bytes] = {}

    def learn(self, texts: list[list[str] | None]) -> None:
        known = self.known
        new = {w for words in texts if words for w in words if w not in known}
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = {w for words in texts if words for w in words}
        new = list(new)
        for i in range(0, len(new), 20_000):
            some = new[i : i + 20_000]
            known.update(zip(some, self.encode(some)))

    def join(self, words: list[str]) -> bytes:
        return b"".join(map(self.known.__getitem__, words))


def grouped(items: Iterable, size: int = TOGETHER) -> Iterator[list]:
    items = iter(items)
    while some := list(islice(items, size)):
        yield some


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class ByteBpe:
    """Ids of a byte-level BPE file of ``tokenizers``, as ``packed`` bytes.

    The file's vocabulary is applied by ``tiktoken``, which merges new words
    some ten times faster and gives the same ids (see the tests). Special
    tokens of the file count as such where their text occurs.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        byte_of = _bytes_by_letter()
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        ranks = {
            bytes(byte_of[c] for c in piece): i for piece, i in file["model"]["vocab"].items() if piece not in special
        }
        self.coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        for text in texts:
            if text:
                yield self.coder.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
            else:
                yield b""


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """The encoder of this Python process, read once."""
    return ByteBpe(path)
