"""Language identification by compression.

Each language has a raw-content zstandard dictionary: bytes of its learning
texts. A text is compressed with each, and the language whose dictionary
leaves the fewest bytes is predicted. Texts are reduced to lower-case letters
and single blanks, on both sides, and compressed in blocks, so that a long
text does not become its own dictionary: the whole text counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import only

UNKNOWN = "und"
#: The bounded sample: so many texts of a language, so many characters of each,
#: in so many languages (the most frequent ones).
SAMPLE_TEXTS = 900
SAMPLE_CHARS = 300
SAMPLE_LANGUAGES = 200
#: Bytes of the sample that a dictionary takes, text by text.
DICTIONARY_BYTES = 1 << 17
#: Texts of the sample, behind those of the dictionary, that the margin is set on.
MARGIN_TEXTS = 300
FEW_TEXTS = 40
#: Share of rightly named texts that a margin may reject.
REJECTED = 0.005
BLOCK_BYTES = 1_024
LEVEL = 3
_OTHER = regex.compile(r"\P{L}+")


@dataclass(frozen=True)
class Dictionaries:
    """Content by language; the more frequent language comes first and wins ties.

    A text is rejected if the second language needs no more bytes than the
    first, or more by less than ``margin`` times the bytes of the first.
    """

    content: dict[str, bytes]
    margin: float = 0.0


def letters(text: str | None) -> str:
    """Lower-case letters (Unicode category L) of ``text``; anything between them is one blank."""
    return _OTHER.sub(" ", text or "").strip().lower()


def _sample(rows: DataFrame, counts: dict[str, int], wanted: int) -> dict[str, list[str]]:
    """By language, cuts of its ``wanted`` distinct texts with the smallest hashes.

    Hashes are even, so a bound on them lets about twice the wanted texts of a
    language through; copies may make them fewer, and then the bound is raised.
    No task gathers a language, and the driver gets what is sampled.
    """
    n = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    cut = F.substring("text", (F.pmod("h", n) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    found: dict[str, list[str]] = {}
    shares = {lang: min(1.0, 2 * wanted / n) for lang, n in counts.items()}
    while shares:
        by_lang = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
        below = (F.col("h").cast("double") / 2.0**64 + 0.5) <= F.try_element_at(by_lang, F.col("lang"))
        held: dict[str, list[tuple[int, str]]] = {lang: [] for lang in shares}
        for r in rows.where(below).select("lang", "h", cut.alias("cut")).distinct().collect():
            held[r["lang"]].append((r["h"], r["cut"]))
        for lang, cuts in held.items():
            if len({h for h, _ in cuts}) < wanted and shares[lang] < 1:
                shares[lang] = min(1.0, shares[lang] * 8)
            else:
                least = sorted({h for h, _ in cuts})[:wanted]
                found[lang] = [c for h, c in sorted(cuts) if least and h <= least[-1]]
                del shares[lang]
    return found


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Dictionaries:
    """Dictionaries from a bounded sample of the labelled rows of ``docs``.

    The sample of a language are its ``SAMPLE_TEXTS`` distinct texts with the
    smallest hashes, of each the ``SAMPLE_CHARS`` characters from a place
    that the hash names. In the order of their hashes they fill the dictionary
    up to ``DICTIONARY_BYTES``; the margin is set on the up to ``MARGIN_TEXTS``
    that come next: it rejects ``REJECTED`` of those that are named rightly and
    not by a tie. Rows without text or language are left out, as are languages
    beyond the ``SAMPLE_LANGUAGES`` most frequent.
    """
    rows = only(docs, text=text_col, lang=lang_col).where("text is not null and lang is not null")
    rows = rows.withColumn("h", F.xxhash64("text"))
    top = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE_LANGUAGES).collect()
    counts = {r["lang"]: r["count"] for r in top}
    sample = _sample(rows, counts, SAMPLE_TEXTS)
    content, asked = {}, []
    for lang in counts:
        cuts = list(dict.fromkeys(filter(None, map(letters, sample[lang]))))
        # A language with fewer texts asks a quarter of them, one with few asks none.
        most = len(cuts) - (len(cuts) // 4 if len(cuts) >= FEW_TEXTS else 0)
        upto = np.cumsum([len(c.encode()) + 1 for c in cuts[:most]])
        learned = int(np.count_nonzero(upto <= DICTIONARY_BYTES + 1))
        content[lang] = " ".join(cuts[:learned]).encode()
        asked += [(lang, c) for c in cuts[learned : learned + MARGIN_TEXTS]]
    dictionaries = Dictionaries(content)
    return Dictionaries(content, _margin(Sizes(dictionaries), asked))


def _margin(sizes: Sizes, asked: list[tuple[str, str]]) -> float:
    right = []
    for lang, text in asked:
        best, _, margin, least = judge(sizes.of(text))
        if sizes.names[best] == lang and margin:
            right.append(margin / least)
    return float(np.quantile(right, REJECTED)) if right else 0.0


class Sizes:
    """Compressed bytes of texts under each dictionary."""

    def __init__(self, dictionaries: Dictionaries):
        self.names = list(dictionaries.content)
        self.compress = []
        for content in dictionaries.content.values():
            options = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, source_size=BLOCK_BYTES, dict_size=len(content), write_content_size=0, write_checksum=0
            )
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            if len(content) >= 8:
                raw.precompute_compress(compression_params=options)
                self.compress.append(zstandard.ZstdCompressor(dict_data=raw, compression_params=options).compress)
            else:
                self.compress.append(zstandard.ZstdCompressor(compression_params=options).compress)

    def of(self, text: str) -> list[int]:
        data = f" {text} ".encode()
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        return [sum(len(c(b)) for b in blocks) for c in self.compress]


def judge(sizes: list[int]) -> tuple[int, float, int, int]:
    """(place of the smallest, confidence, bytes to the second, bytes of the smallest)."""
    least = min(sizes)
    best = sizes.index(least)
    odds = sum(2.0 ** -min(s - least, 1000) for s in sizes)
    rest = sizes[:best] + sizes[best + 1 :]
    return best, 1.0 / odds, (min(rest) if rest else 2 * least) - least, least


def identifier(dictionaries: Dictionaries):
    """A pandas UDF: text to ``lang_pred``, ``score``, ``margin``, ``accepted``.

    A null text, or one without a letter, is ``und`` with score 0 and is not
    accepted; so is every text if nothing was learned. Ties go to the language
    with more learning rows and are not accepted. Repeated texts get the same
    answer, and a text of any length is read to its end.
    """

    @F.pandas_udf("lang_pred string, score double, margin long, accepted boolean")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sizes = Sizes(dictionaries)
        for batch in batches:
            out = []
            for text in batch:
                plain = letters(text)
                if not plain or not sizes.names:
                    out.append((UNKNOWN, 0.0, 0, False))
                    continue
                best, score, margin, least = judge(sizes.of(plain))
                out.append((sizes.names[best], score, margin, margin > 0 and margin >= dictionaries.margin * least))
            frame = pd.DataFrame(out, columns=["lang_pred", "score", "margin", "accepted"])
            yield frame.astype({"score": np.float64, "margin": np.int64, "accepted": bool})

    return identify


def predicted(docs: DataFrame, dictionaries: Dictionaries, text_col: str = "text") -> Column:
    """The prediction for each row, as a struct column; other columns are untouched."""
    if not isinstance(docs.schema[text_col].dataType, T.StringType):
        raise TypeError(f"column {text_col!r} must hold strings")
    return identifier(dictionaries)(F.col(f"`{text_col}`"))
