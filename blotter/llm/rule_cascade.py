"""Quality rules in a short-circuit cascade.

Every rule rejects a text by one measurement. On a sample each rule is timed
and its rejections noted; the rule with the most rejections per second comes
first, then, among the texts it lets pass, the next. A text meets the rules in
that order until one rejects it, and only the measurements met are taken.
The order moves work only: a text is kept if no rule rejects it.

The counts that every text gets (words, symbols, repeated lines and passages)
are taken before; texts that fail on them never enter the cascade.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from time import perf_counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import only

#: Rows, on average, that costs and rejections are estimated on.
SAMPLE = 2_000
#: Words of a passage that counts as repeated if it occurs twice.
PASSAGE = 8
FEWEST_WORDS = 20
#: Percentage of words in repeated passages that a text may have.
MOST_REPEATED = 30

# White space and symbols of the contract; all are single bytes.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: Printed ASCII characters other than letters.
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalpha())

# Frequent short words of four languages.
STOP_TEXT = (
    "the be to of and that have with is in for it was on as by at this from or an a "
    "le la les de des et un une en que pour dans du est sur par au qui se ce il "
    "der die das und ist von mit ein eine im zu nicht auf den dem sich auch es er "
    "el los las y por con del una no su lo como más"
)
STOP_WORDS = frozenset(w.encode() for w in STOP_TEXT.split())


class Text:
    """A text's measurements, each taken when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.data = self.text.encode()

    def _count(self, of: bytes) -> int:
        return len(self.data) - len(self.data.translate(None, of))

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - self._count(SPACE)

    @cached_property
    def n_symbols(self) -> int:
        return self._count(SYMBOLS)

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [line for line in self.data.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)

    @cached_property
    def capitals(self) -> int:
        return self._count(CAPITALS)

    @cached_property
    def marks(self) -> int:
        return self._count(MARKS)

    @cached_property
    def stop_words(self) -> int:
        return len(STOP_WORDS.intersection(w.lower() for w in set(self.words)))

    @cached_property
    def most_frequent(self) -> int:
        return max(Counter(self.words).values(), default=0)

    @cached_property
    def longest(self) -> int:
        """Characters of the longest word."""
        return max(map(len, map(bytes.decode, self.words)), default=0)

    @property
    def base_failed(self) -> bool:
        return self.n_words < FEWEST_WORDS or 100 * self.n_repeat_words > MOST_REPEATED * self.n_words


#: Factors of a passage's hash; odd, so that none loses a bit.
FACTORS = [pow(0x9E3779B97F4A7C15, k, 2**64) for k in range(PASSAGE)]


def repeated_words(words: list[bytes], size: int = PASSAGE) -> int:
    """Words inside passages of ``size`` words that occur twice or more.

    Hashes find the candidates; equal hashes are settled by the words.
    """
    n = len(words) - size + 1
    if n < 2:
        return 0
    one = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    passages = np.zeros(n, np.uint64)
    for k, factor in enumerate(FACTORS[:size]):
        passages += one[k : k + n] * np.uint64(factor)
    order = np.argsort(passages, kind="stable")
    same = np.flatnonzero(passages[order][1:] == passages[order][:-1])
    if not len(same):
        return 0
    held: dict[tuple[bytes, ...], list[int]] = {}
    for at in order[np.union1d(same, same + 1)].tolist():
        held.setdefault(tuple(words[at : at + size]), []).append(at)
    steps = np.zeros(len(words) + 1, np.int64)
    for places in held.values():
        if len(places) > 1:
            np.add.at(steps, places, 1)
            np.add.at(steps, np.array(places) + size, -1)
    return int(np.count_nonzero(np.cumsum(steps)[:-1]))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


RULES = (
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("repeated lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    Rule("word length", lambda t: not 3 * t.n_words <= t.word_chars <= 10 * t.n_words),
    Rule("capitals", lambda t: 10 * t.capitals > 4 * t.word_chars),
    Rule("marks", lambda t: 10 * t.marks > 3 * t.word_chars),
    Rule("exclamations", lambda t: 2 * t.data.count(b"!") > t.n_words),
    Rule("few stop words", lambda t: t.stop_words < 2),
    Rule("one word", lambda t: 4 * t.most_frequent > t.n_words),
    Rule("overlong word", lambda t: t.longest > 500),
)


@dataclass(frozen=True)
class Estimate:
    """A rule's place: its rejections among texts that came so far, and its cost."""

    rule: Rule
    rejected: float
    seconds: float


def _timed(rule: Rule, text: str | None) -> tuple[bool, float]:
    """The rule's verdict, and its time beyond the counts that every text gets."""
    measured = Text(text)
    _ = measured.base_failed, measured.word_chars, measured.n_symbols, measured.n_dup_lines
    start = perf_counter()
    rejected = rule.rejects(measured)
    return rejected, perf_counter() - start


def estimated(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample: int = SAMPLE
) -> list[Estimate]:
    """The rules in the order of the cascade.

    About ``sample`` rows are drawn and every rule is timed on those that pass
    the base checks. The driver gets one row per set of rejecting rules. With
    no row to learn from, the rules keep their order.
    """
    texts = only(docs, text=text_col)
    rows = texts.count()
    if rows > sample:
        texts = texts.sample(fraction=sample / rows, seed=11)

    def timed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[_timed(r, t) for r in rules] for t in batch.column(0).to_pylist() if not Text(t).base_failed]
            sets = ["".join("01"[no] for no, _ in row) for row in found]
            seconds = [[s for _, s in row] for row in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sets, pa.string()), pa.array(seconds, pa.list_(pa.float64()))], ["rejecting", "seconds"]
            )

    spent = [F.sum(F.col("seconds")[i]).alias(f"s{i}") for i in range(len(rules))]
    sets = (
        texts.mapInArrow(timed, "rejecting string, seconds array<double>")
        .groupBy("rejecting")
        .agg(F.count("*").alias("n"), *spent)
        .collect()
    )
    seen = sum(r["n"] for r in sets)
    cost = [sum(r[f"s{i}"] for r in sets) / seen if seen else 0.0 for i in range(len(rules))]
    left, passing, placed = list(range(len(rules))), sets, []
    while left:
        n = sum(r["n"] for r in passing) or 1
        share = {i: sum(r["n"] for r in passing if r["rejecting"][i] == "1") / n for i in left}
        # Rules that reject nothing more come last, the cheapest first.
        best = max(left, key=lambda i: (share[i] / max(cost[i], 1e-12), -cost[i] if seen else 0, -i))
        placed.append(Estimate(rules[best], share[best], cost[best]))
        passing = [r for r in passing if r["rejecting"][best] == "0"]
        left.remove(best)
    return placed


COUNTED = {
    **dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), pa.int64()),
    **dict.fromkeys(("base_failed", "kept"), pa.bool_()),
}


def judge(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept`` per row.

    Null and empty texts have no words and fail the base check, as do texts of
    few words and texts that repeat their passages. Repeated rows are judged
    each; a null id is kept as it is; an empty table gives an empty one. Other
    columns are not read.
    """
    order = [e.rule for e in estimated(docs, rules, text_col, sample)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                t = Text(text)
                failed = t.base_failed
                # any() stops at the first rule that rejects.
                kept = not failed and not any(rule.rejects(t) for rule in order)
                found.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, kept))
            counted = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(COUNTED.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counted], ["doc_id", *COUNTED])

    source = only(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    columns = ", ".join(f"{name} {'boolean' if of == pa.bool_() else 'bigint'}" for name, of in COUNTED.items())
    return source.mapInArrow(rows, f"doc_id {kind}, {columns}")
