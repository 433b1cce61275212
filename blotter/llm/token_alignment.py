"""Alignment of the tokens that two tokenizers cut from the same bytes.

The tokens of both sides are sorted by their start, the running maximum of the
ends is taken, and a group ends where a start reaches it: there a token of A
and one of B end together. Within a group every token of A is linked with
every token of B.

Both tokenizers always cut before a blank, a line feed or a tab that follows
another character, so groups never cross such a place. A text is therefore
parted there, and each distinct segment is encoded and aligned once per task,
many at a time. What a text needs are sums over its segments. Texts that hold
other white space are one segment each.

The number of documents that hold a pair of ids linked is counted by Spark.
The most frequent pairs, at most ``LOOKED_UP`` of them, are looked up in the
tasks; the others, none of which is frequent then, are joined.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import only
from blotter.llm.segments import ByteBpe, grouped
from blotter.runtime import materialise

#: Distinct segments that a Python worker remembers before it drops the rarer ones.
REMEMBERED = 120_000
#: Texts whose new segments are aligned together.
TOGETHER = 128
#: Pairs whose counts are sent to the tasks, 17 bytes each.
LOOKED_UP = 2_000_000
#: Runs of so many characters are encoded by ``tokenizers``.
LONG_SEGMENT = 1_000
#: Bits of an id in a pair, ``a << ID_BITS | b``.
ID_BITS = 20
MARK = "▁"

SEGMENT = re.compile(r"[ \t\n]*[^ \t\n]+|[ \t\n]+")
#: A run that ``tiktoken``, whose time is quadratic in it, should not merge.
OVERLONG = re.compile(rf"\S{{{LONG_SEGMENT}}}|\s{{{LONG_SEGMENT}}}")
#: White space of any kind that is not among the cuts.
OTHER_SPACE = re.compile(r"[^\S \t\n]")


class SideA:
    """Byte-level BPE: ids and the bytes of each."""

    def __init__(self, path: str):
        self.path, self.coder = path, ByteBpe(path).coder
        self.spelled = [b""] * self.coder.n_vocab
        for spelled in self.coder.token_byte_values():
            self.spelled[self.coder.encode_single_token(spelled)] = spelled
        self.lengths = np.array(list(map(len, self.spelled)))

    @cached_property
    def slow(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def encode(self, text: str) -> np.ndarray:
        if OVERLONG.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int64)
        return self.coder.encode_to_numpy(text, disallowed_special=()).astype(np.int64)


class SideB:
    """SentencePiece: texts are encoded behind a line feed, a token of its own."""

    def __init__(self, path: str):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.coder.id_to_piece(i) for i in range(self.coder.get_piece_size())]
        self.spelled = [
            bytes([int(p[3:5], 16)]) if self.coder.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.lengths = np.array(list(map(len, self.spelled)))
        self.lead = self.coder.encode("\n")
        if any(re.search(f".[{MARK}\t\n]|[\t\n].", p.lstrip(MARK)) for p in pieces) or len(self.lead) != 2:
            raise ValueError("a piece of this model goes on across a cut between segments")

    def encode(self, text: str) -> np.ndarray:
        n, ids = len(self.lead), self.coder.encode("\n" + text, num_threads=1)
        # Without the lead the text was changed on the way; it then has no tokens.
        return np.array(ids[n:] if ids[:n] == self.lead else [], np.int64)


def encoded(side: SideA | SideB, segments: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids of segments that follow one another, and how many each has.

    None if a segment's bytes do not come back.
    """
    joined = "".join(segments)
    ids = side.encode(joined)
    if b"".join(map(side.spelled.__getitem__, ids.tolist())) != joined.encode():
        return None
    ends = np.cumsum(side.lengths[ids])
    wanted = np.cumsum([len(s) if s.isascii() else len(s.encode()) for s in segments])
    upto = np.searchsorted(ends, wanted)
    if not np.array_equal(ends[upto], wanted):
        return None
    return ids, np.diff(upto + 1, prepend=0)


def coalesced(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each token, from the ends of tokens that tile one range."""
    starts = [np.concatenate([[0], e[:-1]]) for e in (ends_a, ends_b)]
    start, end = np.concatenate(starts), np.concatenate([ends_a, ends_b])
    side = np.repeat([0, 1], [len(ends_a), len(ends_b)])
    order = np.lexsort((side, start))
    reached = np.maximum.accumulate(end[order])
    group = np.empty(len(order), np.int64)
    group[order] = np.concatenate([[0], np.cumsum(start[order][1:] >= reached[:-1])])
    return group[: len(ends_a)], group[len(ends_a) :]


def _distinct(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, times) of the distinct ids of each group, in group order."""
    codes, times = np.unique(group << ID_BITS | ids, return_counts=True)
    return codes >> ID_BITS, codes & (2**ID_BITS - 1), times


def links(group_a: np.ndarray, ids_a: np.ndarray, group_b: np.ndarray, ids_b: np.ndarray):
    """(group, pair, times): all pairs of ids that share a group."""
    ga, a, times_a = _distinct(group_a, ids_a)
    gb, b, times_b = _distinct(group_b, ids_b)
    size = np.bincount(gb)
    first = np.cumsum(size) - size
    fan = size[ga]
    left = np.repeat(np.arange(len(ga)), fan)
    right = np.arange(len(left)) - np.repeat(np.cumsum(fan) - fan, fan) + np.repeat(first[ga], fan)
    return ga[left], a[left] << ID_BITS | b[right], times_a[left] * times_b[right]


class Aligner:
    """Alignments of segments, learned in batches and remembered."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = SideA(path_a), SideB(path_b)
        most = max(len(self.a.spelled), len(self.b.spelled))
        if most >= 2**ID_BITS:
            raise ValueError(f"ids must lie below {2**ID_BITS}")
        #: An id and the mark behind it: more of its side, the other side, the next group.
        self.marked = [str(i).encode() + mark for mark in (b",", b"|", b";") for i in range(most)]
        self.marked_length = np.array(list(map(len, self.marked)))
        #: Segment to its number; -1 if its bytes do not come back.
        self.number: dict[str, int] = {}
        #: ``a1,a2|b1;`` for each group.
        self.texts: list[bytes] = []
        #: n_a, n_b, n_groups, n_links by segment.
        self.sums = np.zeros((0, 4), np.int64)
        self.first = np.zeros(1, np.int64)
        self.pair = np.zeros(0, np.int64)
        self.times = np.zeros(0, np.int32)
        #: Groups of texts that a segment was found in.
        self.used = np.zeros(0, np.int32)

    def _forget(self, needed: set[str]) -> None:
        """Keep the segments needed now and, of the others, the more used half at most."""
        rank = np.sort(self.used)[::-1]
        least = max(2, rank[REMEMBERED // 2] + 1) if len(rank) > REMEMBERED // 2 else 2
        often = self.used >= least
        kept = [(s, i) for s, i in self.number.items() if s in needed or (i >= 0 and often[i])]
        at = np.array([i for _, i in kept if i >= 0], np.int64)
        held = self.first[at + 1] - self.first[at]
        index = np.arange(held.sum()) + np.repeat(self.first[at] - (np.cumsum(held) - held), held)
        self.pair, self.times = self.pair[index], self.times[index]
        self.first = np.concatenate([[0], np.cumsum(held)])
        self.sums, self.used = self.sums[at], self.used[at] // 2
        self.texts = [self.texts[i] for i in at.tolist()]
        new = iter(range(len(at)))
        self.number = {s: -1 if i < 0 else next(new) for s, i in kept}

    def learn(self, segments: set[str]) -> None:
        new = [s for s in segments if s not in self.number]
        if len(self.number) + len(new) > REMEMBERED and self.number:
            self._forget(segments)
        # Segments that start with a blank and end without one can follow one another.
        chained = [s for s in new if len(s) < LONG_SEGMENT and s[0] in " \t\n" and not s[-1].isspace()]
        for some in grouped(chained, 5_000):
            self._align(some)
        for s in set(new).difference(chained):
            self._align([s])

    def _align(self, segments: list[str]) -> None:
        found = encoded(self.a, segments), encoded(self.b, segments)
        if found[0] is None or found[1] is None:
            if len(segments) == 1:
                self.number[segments[0]] = -1
            else:
                half = len(segments) // 2
                self._align(segments[:half])
                self._align(segments[half:])
            return
        (flat_a, count_a), (flat_b, count_b) = found
        n = len(segments)
        of_a = np.repeat(np.arange(n), count_a)
        group_a, group_b = coalesced(np.cumsum(self.a.lengths[flat_a]), np.cumsum(self.b.lengths[flat_b]))
        owner = np.empty(int(group_a[-1]) + 1, np.int64)
        owner[group_a] = of_a
        group, pair, times = links(group_a, flat_a, group_b, flat_b)
        of_pair = owner[group]
        sums = [count_a, count_b, np.bincount(owner, minlength=n), np.bincount(of_pair, times, n).astype(np.int64)]
        self.texts += self._spelled(group_a, flat_a, group_b, flat_b, owner)
        self.number.update(zip(segments, range(len(self.sums), len(self.sums) + n)))
        self.sums = np.concatenate([self.sums, np.stack(sums, axis=1)])
        self.used = np.concatenate([self.used, np.zeros(n, np.int32)])
        held = np.bincount(of_pair, minlength=n)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(held)])
        self.pair = np.concatenate([self.pair, pair])
        self.times = np.concatenate([self.times, times.astype(np.int32)])

    def _spelled(self, group_a, flat_a, group_b, flat_b, owner) -> list[bytes]:
        """``a1,a2|b1;a3|b2;`` for each segment."""
        last = [np.diff(group, append=-1) != 0 for group in (group_a, group_b)]
        most = len(self.marked) // 3
        marked = np.concatenate([flat_a + most * last[0], flat_b + 2 * most * last[1]])
        group = np.concatenate([group_a, group_b])
        order = np.lexsort((np.repeat([0, 1], [len(group_a), len(group_b)]), group))
        marked = marked[order]
        whole = b"".join(map(self.marked.__getitem__, marked.tolist()))
        ends = np.cumsum(self.marked_length[marked])[np.flatnonzero(np.diff(owner[group[order]], append=-1))].tolist()
        return [whole[x:y] for x, y in zip([0, *ends], ends)]

    def documents(self, texts: list[str | None]) -> list[tuple | None]:
        """(sums, digest of the groups, pairs, times); None for a text without tokens."""
        cut = [[] if not t else [" " + t] if OTHER_SPACE.search(t) else SEGMENT.findall(" " + t) for t in texts]
        self.learn(set(chain.from_iterable(cut)))
        numbers = [list(map(self.number.__getitem__, own)) for own in cut]
        kept = [i for i, own in enumerate(numbers) if own and min(own) >= 0]
        found: list[tuple | None] = [None] * len(texts)
        if not kept:
            return found
        at = np.array(list(chain.from_iterable(numbers[i] for i in kept)))
        sizes = [len(numbers[i]) for i in kept]
        self.used[at] += 1  # once for each segment, however often it occurs
        starts = np.cumsum([0, *sizes[:-1]])
        sums = np.add.reduceat(self.sums[at], starts)
        first = self.first[at]
        held = self.first[at + 1] - first
        index = np.arange(held.sum()) + np.repeat(first - (np.cumsum(held) - held), held)
        of = np.repeat(np.repeat(np.arange(len(kept)), sizes), held)
        codes, where = np.unique(of << 2 * ID_BITS | self.pair[index], return_inverse=True)
        times = np.bincount(where, self.times[index], len(codes)).astype(np.int64)
        edges = np.searchsorted(codes >> 2 * ID_BITS, np.arange(len(kept) + 1)).tolist()
        pairs = codes & (2 ** (2 * ID_BITS) - 1)
        for k, i in enumerate(kept):
            digest = hashlib.sha256(b"".join(map(self.texts.__getitem__, numbers[i]))[:-1]).hexdigest()
            found[i] = sums[k], digest, pairs[edges[k] : edges[k + 1]], times[edges[k] : edges[k + 1]]
        return found


@lru_cache(maxsize=2)
def aligner_of(path_a: str, path_b: str) -> Aligner:
    """The aligner of this Python process: what it has learned outlives a task."""
    return Aligner(path_a, path_b)


NONE = np.zeros(0, np.int64)
SUMS = ("n_a", "n_b", "n_groups", "n_links")


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([NONE, *values])))


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``SUMS``, ``groups_sha256``, ``pairs``, ``times`` of each row.

    ``pairs`` are the distinct linked pairs of ids, ``times`` how often each is
    linked.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(path_a, path_b)
        none = (np.zeros(4, np.int64), "", NONE, NONE)
        for batch in batches:
            # Small batches: a text's pairs may take more room than the text.
            for at in range(0, len(batch), TOGETHER):
                part = batch.slice(at, TOGETHER)
                found = [none if x is None else x for x in aligner.documents(part.column(1).to_pylist())]
                sums = np.stack([x[0] for x in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        *[pa.array(sums[:, i]) for i in range(4)],
                        pa.array([x[1] for x in found], pa.string()),
                        _lists([x[2] for x in found]),
                        _lists([x[3] for x in found]),
                    ],
                    names=["doc_id", *SUMS, "groups_sha256", "pairs", "times"],
                )

    source = only(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        rows,
        f"doc_id {kind}, {', '.join(f'{c} bigint' for c in SUMS)}, groups_sha256 string, "
        "pairs array<bigint>, times array<bigint>",
    )


def pair_counts(stored: DataFrame) -> DataFrame:
    """``pair``, ``n`` (rows that hold it), ``best`` (the highest ``n`` of its A id).

    The counts of one A id are at most as many as B has ids; their maximum is
    taken by a partial aggregation and joined back.
    """
    counts = materialise(
        stored.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs"
    )
    a = F.shiftright("pair", ID_BITS)
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("highest"))
    return counts.withColumn("a", a).join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _looked_up(counts: DataFrame, limit: int) -> tuple[int, list[np.ndarray]]:
    """The level from which counts are looked up, and those counts by pair."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = {r[0]: r[1] for r in counts.groupBy(level).agg(F.count("*")).collect()}
    least, room = max(sizes, default=0) + 1, limit
    while least and sizes.get(least - 1, 0) <= room:
        least -= 1
        room -= sizes.get(least, 0)
    top = counts.where(F.col("n") >= 2**least).select("pair", "n", "best").toArrow()
    order = np.argsort(top["pair"].to_numpy())
    return least, [np.asarray(top[c].to_numpy())[order] for c in ("pair", "n", "best")]


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    looked_up: int = LOOKED_UP,
) -> DataFrame:
    """``doc_id``, ``SUMS``, ``n_best``, ``count_sum``, ``groups_sha256`` per row.

    Side A encodes a blank and the text, side B the text, to which it adds that
    blank itself; special tokens are plain text. ``n_best`` counts the links
    whose pair is found in as many rows as any pair of its A id, ``count_sum``
    adds up, over the links, the number of rows that hold the pair.

    Null and empty texts, and texts whose bytes one side does not give back
    (such as those that hold the blank mark of B), have zeros and no digest.
    Repeated rows are reported each and counted each; a null id is kept; an
    empty table gives an empty one. Other columns are not read.
    """
    stored = materialise(aligned(docs, path_a, path_b, id_col, text_col), "aligned")
    counts = materialise(pair_counts(stored), "counts")
    least, (pair, n, best) = _looked_up(counts, looked_up)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner = np.repeat(np.arange(len(batch)), np.diff(batch["pairs"].offsets.to_numpy()))
            mine, times = (batch[c].flatten().to_numpy() for c in ("pairs", "times"))
            at = np.minimum(np.searchsorted(pair, mine), max(len(pair) - 1, 0))
            hit = pair[at] == mine if len(pair) else np.zeros(len(mine), bool)
            at, of, by = at[hit], owner[hit], times[hit]
            # Whole numbers up to 2**53 are exact as weights; larger sums are not expected of one text.
            n_best = np.bincount(of, by * best[at], len(batch)).astype(np.int64)
            count_sum = np.bincount(of, by * n[at].astype(float), len(batch)).astype(np.int64)
            kept = [batch[c] for c in ("doc_id", *SUMS)]
            new = [pa.array(n_best), pa.array(count_sum), batch["groups_sha256"]]
            names = ["doc_id", *SUMS, "n_best", "count_sum", "groups_sha256"]
            if least:
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner[~hit], minlength=len(batch)))]).astype(np.int32)
                new += [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[~hit])) for x in (mine, times)]
                names += ["pairs", "times"]
            yield pa.RecordBatch.from_arrays(kept + new, names=names)

    kind = stored.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, {', '.join(f'{c} bigint' for c in SUMS)}, n_best bigint, count_sum bigint, groups_sha256 string"
    )
    if not least:
        return stored.mapInArrow(rows, schema)
    part = materialise(
        stored.mapInArrow(rows, f"{schema}, pairs array<bigint>, times array<bigint>").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "looked-up",
    )
    rest = (
        part.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
        .select("row", "x.*")
        .withColumnsRenamed({"pairs": "pair"})
        .join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
    )
    return part.join(rest, "row", "left").select(
        "doc_id",
        *SUMS,
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
