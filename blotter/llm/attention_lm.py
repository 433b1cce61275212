"""Language-model scores: a causal self-attention model beside a word count.

The attention model reads the subword ids of a text (``A-Z`` lower-cased) in
windows that overlap: each window after the first starts with ``CONTEXT`` ids
it does not score, so every id is scored once. Windows of many texts go through
the masked attention together. It starts from how often a class of ids followed
the id before, and attention over the window raises or lowers the classes; the sum over
classes keeps it a probability. Within its class an id has its share after the
id before. That share is counted for every pair of ids: the most frequent pairs
are looked up in tables of bounded size, and all others are joined with the counts.

Ids and pairs of ids are counted over the whole of every learning text, and
the attention weights take steps on every window of it, dealt over the rounds, so
that every id of every learning text is a target once. Each task makes its
own steps from common weights, and Spark averages the outcomes, round by
round; weights and counts are bounded by the model, what they are taken from
grows with the corpus.

The word count beside it is exact: the most frequent words are looked up in a
table of bounded size, and all others are joined with the counts of all words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import id_hash, only
from blotter.llm.multi_index import codebook
from blotter.llm.segments import byte_bpe, grouped
from blotter.runtime import materialise

CLASSES = 64
#: Classes of one id; the other ids are grouped by what follows them.
ALONE = 44
#: One more than the most frequent ids, whose pairs are looked up in a square
#: table and whose successors the groups are fitted to.
KEPT = 1_024
#: Counts that even shares are worth where successors are few.
SMOOTH = 4.0
WIDTH = 16
WINDOW = 16
CONTEXT = 4
END = 50_256
VOCABULARY = 50_257
#: Parts of the windows that each round takes, in sixteenths: weights that are
#: still far off are averaged early.
ROUNDS = (1, 1, 2, 4, 8)
#: Windows that go through attention together; few enough to stay in the cache.
BATCH = 48
#: The same where they are scored, which takes less room.
SCORED_TOGETHER = 96
RATE = 0.01
#: Words that are looked up in a broadcast table instead of a join.
FREQUENT_WORDS = 200_000
#: Pairs outside the square table that are looked up instead of a join.
FREQUENT_PAIRS = 500_000
#: Pairs that a task gathers before it counts and hands them on.
PAIRS_HELD = 2_000_000
#: Distinct words that a task counts before it hands them on.
WORDS_HELD = 200_000
#: Texts whose windows are made together.
TEXTS_TOGETHER = 128
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Largest exponent; exp of it fits 32-bit floats with room for a sum.
PEAK = np.float32(60)
_SEEN = np.tril(np.ones((WINDOW, WINDOW), np.float32))

Weights = dict[str, np.ndarray]


@dataclass
class Inside:
    """Log shares of ids within their class after an id, but for ``within`` of the model.

    ``place``: ids to rows of ``square``, the last one for ids that have none;
    ``square`` and ``gains`` (of the sorted pairs ``keys``): what having followed
    the id adds; ``level``: logs of how often ids come.
    """

    place: np.ndarray
    square: np.ndarray
    keys: np.ndarray
    gains: np.ndarray
    level: np.ndarray
    class_of: np.ndarray
    pairs: np.ndarray

    def __getitem__(self, key: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        last, after = map(np.atleast_1d, key)
        return self.shares(last, after)[0].reshape(np.shape(key[1]))

    def shares(self, last: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of ids after ids, and the places of pairs that neither table has."""
        row, column = self.place[last], self.place[after]
        size = len(self.square)
        out = np.take(self.square.ravel(), row * size + column)
        out -= np.take(self.level, last)
        out -= np.take(self.pairs.ravel(), last * self.pairs.shape[1] + self.class_of[after])
        rare = np.flatnonzero(np.maximum(row, column) == size - 1)
        if not len(self.keys):
            return out, rare
        pair = last[rare].astype(np.int64) * VOCABULARY + after[rare]
        # In order, neighbours find theirs in the same few rows.
        order = np.argsort(pair)
        rare, pair = rare[order], pair[order]
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        found = self.keys[at] == pair
        out[rare[found]] += self.gains[at[found]]
        return out, np.sort(rare[~found])


@dataclass
class Model:
    """``kept``: ids as the model tells them apart, each its own; ``class_of``: ids to
    classes; ``pairs``: log shares of classes after ids; ``inside``: with ``within``, log
    shares of ids within their class, after ids; ``within``: what ids have of it by themselves."""

    kept: np.ndarray
    class_of: np.ndarray
    pairs: np.ndarray
    inside: Inside
    within: np.ndarray
    weights: Weights


def start_weights(classes: int = CLASSES, width: int = WIDTH, seed: int = 0) -> Weights:
    rng = np.random.default_rng(seed)
    shapes = {"e": (classes, width), "p": (WINDOW, width), "qkv": (width, 3 * width), "u": (width, classes)}
    shapes |= {k: (width, width) for k in ("o", "x")}
    out = {k: rng.normal(0, 0.1 if k in "ep" else s[0] ** -0.5, s).astype(np.float32) for k, s in shapes.items()}
    out["u"][:] = 0
    return out


def _projections(w: Weights) -> np.ndarray:
    """What makes queries (scaled already), keys, values and the unattended part of ids, side by side."""
    d = w["e"].shape[1]
    out = np.concatenate([w["qkv"], w["x"]], axis=1)
    out[:, :d] *= out.dtype.type(d**-0.5)
    return out


def _spread_sums(rows: np.ndarray, width: int) -> np.ndarray:
    """Sum of each of ``rows``, ``width`` times; products run faster than sums over short rows."""
    return rows.reshape(-1, rows.shape[-1]) @ np.ones((rows.shape[-1], width), rows.dtype)


def _attention(q: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Exponents of the scores of keys up to each query's own, but for a factor of each
    query; fewer queries than keys are the last ones."""
    s = np.matmul(q, np.ascontiguousarray(k.transpose(0, 2, 1)))
    seen = _SEEN[k.shape[1] - q.shape[1] : k.shape[1], : k.shape[1]]
    # Where exponents would leave the range, the largest that a query sees becomes 0.
    if s.size and not (s.max() <= PEAK and s.min() >= -PEAK):
        s[:, seen == 0] = -np.inf
        s -= s.max(axis=2, keepdims=True)
    np.exp(s, out=s)
    s *= seen
    return s


def _hidden(w: Weights, ids: np.ndarray) -> Weights:
    """``forward`` up to what the scores are made of."""
    n, length = ids.shape
    d = w["e"].shape[1]
    x = np.take(w["e"], ids.ravel(), axis=0)
    x.reshape(n, length, d)[:] += w["p"][:length]
    every = _projections(w)
    qkvz = (x @ every).reshape(n, length, 4 * d)
    q, k, v, z = (qkvz[..., at : at + d] for at in range(0, 4 * d, d))
    a = _attention(q, k)
    a /= _spread_sums(a, length).reshape(a.shape)
    o = np.matmul(a, v).reshape(n * length, d)
    y = o @ w["o"]
    y += z.reshape(n * length, d)
    return {"x": x, "every": every, "q": q, "k": k, "v": v, "a": a, "o": o, "y": np.maximum(y, 0, out=y)}


def _logits(y: np.ndarray, u: np.ndarray, pairs: np.ndarray, last: np.ndarray) -> np.ndarray:
    logits = y @ u
    logits += np.take(pairs, last.ravel(), axis=0)
    return logits


def forward(w: Weights, pairs: np.ndarray, last: np.ndarray, ids: np.ndarray) -> Weights:
    """Masked attention over windows of classes ``ids`` (n, at most WINDOW).

    ``last`` are the ids of the same places, whose successors the scores
    start from. Exponents of the logits are cut at ``PEAK``, those of attention
    are whole.
    """
    f = _hidden(w, ids)
    return f | {"logits": np.minimum(_logits(f["y"], w["u"], pairs, last), PEAK)}


def _exponents(
    y: np.ndarray, u: np.ndarray, pairs: np.ndarray, last: np.ndarray, at: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponents of the scores, cut at ``PEAK``, their sums, and the scores ``at`` some places."""
    ones = np.ones(u.shape[1], u.dtype)
    with np.errstate(over="ignore"):
        p = _logits(y, u, pairs, last)
        own = np.take(p.ravel(), at)
        np.exp(p, out=p)
        sums = p @ ones
    # Where no sum is beyond the cut, neither is an exponent.
    if sums.size and not sums.max() <= np.exp(PEAK):
        p = np.minimum(_logits(y, u, pairs, last), PEAK)
        own = np.take(p.ravel(), at)
        np.exp(p, out=p)
        sums = p @ ones
    return p, sums, own


@cache
def _units(n: int, kind: str) -> np.ndarray:
    return np.eye(n, dtype=kind)


def gradients(w: Weights, pairs: np.ndarray, last: np.ndarray, ids: np.ndarray, target: np.ndarray) -> tuple[float, Weights]:
    """Mean loss and its gradients; ``target`` -1 is padding."""
    logs, g = _backward(w, pairs, last, ids, target)
    return -np.maximum(logs, math.log(1e-30))[target.ravel() >= 0].sum() / max(1, np.count_nonzero(target >= 0)), g


def _backward(w: Weights, pairs: np.ndarray, last: np.ndarray, ids: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, Weights]:
    """Log shares of the targets, and gradients of their mean loss."""
    f = _hidden(w, ids)
    n, length = ids.shape
    classes, d = w["e"].shape
    y = f["y"]
    wanted = target.ravel()
    padded = np.flatnonzero(wanted < 0)
    at = np.arange(0, n * length * classes, classes) + (np.maximum(wanted, 0) if len(padded) else wanted)
    p, sums, logs = _exponents(y, w["u"], pairs, last, at)
    kind = p.dtype
    # Shares less what is wanted, but for a number for each place.
    p.ravel()[at] -= sums
    logs -= np.log(sums)
    number = 1 / (sums * kind.type(max(1, len(wanted) - len(padded))))
    number[padded] = 0
    number = number[:, None]
    g = {"u": (y * number).T @ p}
    flat = np.empty((n * length, 4 * d), kind)
    dz = p @ np.ascontiguousarray(w["u"].T)
    dz *= number
    dz *= y > 0
    flat[:, 3 * d :] = dz
    g["o"] = f["o"].T @ dz
    do = dz @ w["o"].T
    less = _spread_sums(do * f["o"], length).reshape(n, length, length)
    do = do.reshape(n, length, d)
    parts = flat.reshape(n, length, 4 * d)
    np.matmul(f["a"].transpose(0, 2, 1), do, out=parts[..., 2 * d : 3 * d])
    ds = np.matmul(do, np.ascontiguousarray(f["v"].transpose(0, 2, 1)))
    ds -= less
    ds *= f["a"]
    np.matmul(ds, f["k"], out=parts[..., :d])
    np.matmul(ds.transpose(0, 2, 1), f["q"], out=parts[..., d : 2 * d])
    every = f["x"].T @ flat
    every[:, :d] *= kind.type(d**-0.5)
    g["qkv"], g["x"] = every[:, : 3 * d], every[:, 3 * d :]
    dx = flat @ np.ascontiguousarray(f["every"].T)
    g["p"] = np.zeros_like(w["p"])
    g["p"][:length] = (np.ones(n, kind) @ dx.reshape(n, length * d)).reshape(length, d)
    # In the place of the shares, which have done their part: less to keep in the cache.
    g["e"] = np.take(_units(classes, kind.char), ids.ravel(), axis=0, out=p, mode="clip").T @ dx
    return logs, g


class Steps:
    """Adam on batches of windows, from given weights, which it holds in one row."""

    def __init__(self, weights: Weights, pairs: np.ndarray, class_of: np.ndarray, rate: float = RATE):
        self.row = np.concatenate([v.ravel() for v in weights.values()])
        self.w = unrolled(self.row, weights)
        # Sums of the gradients and of their squares, faded: 10 and 100 times the means.
        self.m, self.s = np.zeros_like(self.row), np.zeros_like(self.row)
        # -1, padding, takes the last one.
        self.pairs, self.class_of, self.rate, self.t = pairs, np.append(class_of, -1), rate, 0

    def take(self, windows: np.ndarray, seed: int) -> None:
        """One pass over ``windows`` of ids (-1: padding), in a fixed random order."""
        windows = windows[np.random.default_rng(seed).permutation(len(windows))]
        classes = self.class_of[windows]
        last, ids = np.maximum(windows[:, :-1], 0), np.maximum(classes[:, :-1], 0)
        target = np.ascontiguousarray(classes[:, 1:])
        for at in range(0, len(windows), BATCH):
            some = slice(at, at + BATCH)
            _, g = _backward(self.w, self.pairs, last[some], ids[some], target[some])
            own = np.concatenate([g[k].ravel() for k in self.w])
            self.t += 1
            self.m *= 0.9
            self.m += own
            own *= own
            self.s *= 0.99
            self.s += own
            near, far = 1 - 0.9 ** min(self.t, 500), 1 - 0.99 ** min(self.t, 5_000)
            step = np.multiply(self.s, 0.01 / far, out=own)
            np.sqrt(step, out=step)
            step += 1e-8
            np.divide(self.m, step, out=step)
            step *= 0.1 * self.rate / near
            self.row -= step


def unrolled(row: np.ndarray, like: Weights) -> Weights:
    """Views of one row of numbers, in the shapes of ``like``."""
    ends = np.cumsum([v.size for v in like.values()])
    return {k: row[e - v.size : e].reshape(v.shape) for (k, v), e in zip(like.items(), ends)}


@dataclass
class Lines:
    """Ids of texts one after another, and where each starts."""

    ids: np.ndarray
    start: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, packed: list[bytes]) -> Lines:
        length = np.array([len(x) // 2 for x in packed], np.int64)
        return cls(np.frombuffer(b"".join(packed), "<u2").astype(np.int32), np.cumsum(length) - length, length)

    def windows(self, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """``WINDOW`` + 1 ids of each text named from place ``at`` on; place 0 and
        the one behind the last id hold the end, -1 stands behind it."""
        place = np.arange(WINDOW + 1)
        # Behind all texts the line goes on for a window, so that none reaches beyond it.
        found = np.append(self.line(), np.full(WINDOW, -1, np.int32))[(self.start[text] + text + at)[:, None] + place]
        length = self.length[text]
        late = np.flatnonzero(at + WINDOW - 1 > length)
        found[late] = np.where(at[late, None] + place - 1 > length[late, None], -1, found[late])
        return found

    def line(self) -> np.ndarray:
        """All ids, an end before each text and behind the last."""
        return np.insert(self.ids, np.append(self.start, len(self.ids)), END)


def _spread(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and number of each of ``n`` things that the owners have."""
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)


def _windows(lines: Lines) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that score each id and the end of each text once: the ids before,
    the ids to score (-1 where a window scores none), and the text of each."""
    step = WINDOW - CONTEXT
    owner, number = _spread(1 + np.maximum(0, -(-(lines.length + 1 - WINDOW) // step)))
    found = lines.windows(owner, number * step)
    targets = found[:, 1:].copy()
    targets[number > 0, :CONTEXT] = -1
    return found[:, :-1], targets, owner


def _by_place(model: Model) -> tuple[np.ndarray, ...]:
    """Queries, keys, what values add and what is unattended, of each class at each
    place of a window, class after class; and the classes of ids."""
    w = model.weights
    d = w["e"].shape[1]
    x = (w["e"][:, None] + w["p"]).reshape(-1, d)
    q, k, v, z = np.matmul(x, _projections(w).reshape(d, 4, d).transpose(1, 0, 2))
    return q, k, v @ w["o"], z, model.class_of[model.kept]


def class_shares(model: Model, inputs: np.ndarray, targets: np.ndarray, skip: int = 0, made: tuple[np.ndarray, ...] = ()) -> np.ndarray:
    """Natural logs of the shares of the classes of ``targets`` (n, length), 0 where there is none.

    ``inputs`` are the ids before them; both may be padded by -1. The first ``skip``
    places are only looked back on and left out. ``made``: ``_by_place`` of the model.
    """
    q, k, v, z, class_of = made or _by_place(model)
    (n, length), d = inputs.shape, q.shape[1]
    # Padding stands for the last id: what it gives is left out.
    every = class_of[inputs]
    every *= WINDOW
    every += np.arange(length)
    late = every[:, skip:].ravel()
    every = every.ravel()
    a = _attention(np.take(q, late, axis=0).reshape(n, -1, d), np.take(k, every, axis=0).reshape(n, length, d))
    y = np.matmul(a, np.take(v, every, axis=0).reshape(n, length, d)).reshape(-1, d)
    y /= _spread_sums(a, d)
    y += np.take(z, late, axis=0)
    np.maximum(y, 0, out=y)
    wanted = targets[:, skip:]
    classes = model.pairs.shape[1]
    at = np.arange(0, len(late) * classes, classes) + class_of[wanted].ravel()
    _, sums, logs = _exponents(y, model.weights["u"], model.pairs, model.kept[inputs[:, skip:]], at)
    logs -= np.log(sums)
    return np.where(wanted >= 0, logs.reshape(wanted.shape), 0)


def log_shares(model: Model, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural logs of the shares of ``targets``, as ``class_shares`` has those of their classes."""
    out = class_shares(model, inputs, targets).astype(float)
    place = targets >= 0
    before, wanted = model.kept[np.maximum(inputs[place], 0)], targets[place]
    out[place] += model.inside[before, model.kept[wanted]] + model.within[wanted]
    return out


def score(model: Model, lines: Lines) -> np.ndarray:
    """log10 probability of each text's ids and the end behind them, many windows at a time."""
    return score_and_missing(model, lines)[0]


def class_total(model: Model, lines: Lines) -> np.ndarray:
    """Sums of ``class_shares`` over each text."""
    inputs, targets, owner = _windows(lines)
    made = _by_place(model)
    total = np.zeros(len(lines.length))
    # Windows after a text's first have places that they only look back on.
    first = targets[:, 0] >= 0
    for mine, skip in ((first, 0), (~first, CONTEXT)):
        some, wanted, texts = inputs[mine], targets[mine], owner[mine]
        sums = [np.zeros(0)]
        for at in range(0, len(some), SCORED_TOGETHER):
            batch = slice(at, at + SCORED_TOGETHER)
            sums.append(class_shares(model, some[batch], wanted[batch], skip, made).sum(axis=1, dtype=float))
        total += np.bincount(texts, np.concatenate(sums), len(total))
    return total


def score_and_missing(model: Model, lines: Lines) -> tuple[np.ndarray, list[np.ndarray]]:
    """``score``, and the pairs of each text that the model's tables do not have."""
    total = class_total(model, lines)
    # Every id is scored once: its share within its class needs no windows.
    last, after = _last_and_after(lines)
    own, missing = model.inside.shares(model.kept[last], model.kept[after])
    # A text of n ids has n + 1 pairs.
    texts = np.repeat(np.arange(len(total)), lines.length + 1)
    total += np.bincount(texts, own + model.within[after], len(total))
    pair = last[missing].astype(np.int64) * VOCABULARY + after[missing]
    ends = np.searchsorted(texts[missing], np.arange(len(total)), side="right")
    return total / math.log(10), np.split(pair, ends[:-1]) if len(total) else []


def _count_ids(total: np.ndarray, lines: Lines) -> None:
    total += np.bincount(lines.ids, minlength=len(total))
    total[END] += len(lines.length)


def pairs_of(lines: Lines) -> np.ndarray:
    """Each id and end of each text with the id before it, as one number: an end stands before the first."""
    last, after = _last_and_after(lines)
    return last.astype(np.int64) * VOCABULARY + after


def _last_and_after(lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Each id and end of each text, and the id before it."""
    line = lines.line()
    return line[:-1], line[1:]


def pair_counts(encoded: DataFrame) -> DataFrame:
    """``pair`` (see ``pairs_of``), ``c``: how often it occurs in texts of ``ids``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], ["pair", "c"])

        for batch in batches:
            for some in grouped(batch.column(0).to_pylist(), TEXTS_TOGETHER):
                held.append(pairs_of(Lines.of(some)))
                if sum(map(len, held)) > PAIRS_HELD:
                    yield counted()
        yield counted()

    return encoded.mapInArrow(rows, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c"))


def _gathered(counted: DataFrame, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sums of the counts of pairs by the row of the id before and the column of the
    id after it; both are at least 0 and bounded, or -1 where pairs are left out."""
    width = int(columns.max()) + 1

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, n = batch.column("pair").to_numpy(), batch.column("c").to_numpy()
            row, column = rows[pair // VOCABULARY], columns[pair % VOCABULARY]
            mine = (row >= 0) & (column >= 0)
            yield pa.RecordBatch.from_arrays([pa.array((row * width + column)[mine]), pa.array(n[mine])], ["i", "n"])

    found = counted.mapInArrow(summed, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((int(rows.max()) + 1) * width)
    out[found["i"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(-1, width)


def _count_pairs(total: np.ndarray, lines: Lines, kept: np.ndarray) -> None:
    pair = pairs_of(lines)
    pairs, n = np.unique(kept[pair // VOCABULARY] * KEPT + kept[pair % VOCABULARY], return_counts=True)
    total[pairs] += n


def spread_windows(lines: Lines, kept: np.ndarray, number: int, rounds: tuple[int, ...] = ROUNDS) -> np.ndarray:
    """Windows of ids as ``kept`` has them (-1: padding) of round ``number``: all rounds together
    have each id of each text, and its end, as a target once."""
    owner, place = _spread(-(-(lines.length + 1) // WINDOW))
    # A text's windows are dealt in turn, from a part that its length names.
    part = (place + lines.length[owner]) % sum(rounds) - sum(rounds[:number])
    mine = np.flatnonzero((part >= 0) & (part < rounds[number]))
    found = lines.windows(owner[mine], place[mine] * WINDOW)
    return np.where(found >= 0, kept[found], -1)


def _classes(shares: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Class of each id: the first of ``frequent`` stand alone; others are grouped by
    their successors' ``shares``, by groups that are fitted to the frequent ones."""
    shape = np.sqrt(shares).astype(np.float32)
    centres = codebook(shape[frequent[ALONE:]], CLASSES - ALONE)
    out = ALONE + ((centres**2).sum(1) - 2 * shape @ centres.T).argmin(1)
    out[frequent[:ALONE]] = np.arange(ALONE)
    return out


def learn(encoded: DataFrame, rounds: tuple[int, ...] = ROUNDS) -> Model:
    """Model from ``ids`` (binary, unsigned 16-bit) of whole texts; without any, even shares."""
    return learn_all(encoded, rounds)[0]


def learn_all(encoded: DataFrame, rounds: tuple[int, ...] = ROUNDS) -> tuple[Model, DataFrame | None]:
    """The model, and ``pair``, ``gain`` of the counted pairs that its tables have no
    room for (None if there are none): to be added for each such pair of a text."""
    stored = encoded.select("ids")
    counted = materialise(pair_counts(stored), "pair-counts")
    every = np.arange(VOCABULARY)
    # Each id and end of a text stands behind one other.
    counts = _gathered(counted, np.zeros(VOCABULARY, np.int64), every)[0]
    alone = (counts + 0.5) / (counts.sum() + 0.5 * VOCABULARY)
    some = np.where(np.arange(VOCABULARY) == END, np.maximum(counts, 1), counts)
    frequent = np.argsort(-some, kind="stable")[: KEPT - 1]
    others = len(frequent)
    place = np.full(VOCABULARY, others, np.int64)
    place[frequent] = np.arange(others)
    square = _gathered(counted, place, place)
    square[-1], square[:, -1] = 0, 0
    square[:-1, :-1] = np.log1p(square[:-1, :-1] / (SMOOTH * alone[frequent]))
    level = np.log(counts + SMOOTH)[:, None]
    near = frequent[: 2 * ALONE]
    follows = _gathered(counted, every, np.where(place < len(near), place, -1)) + SMOOTH * alone[near]
    class_of = _classes(follows / np.exp(level), frequent)
    follows = _gathered(counted, every, class_of)
    of_class = np.bincount(class_of, alone, CLASSES)
    follows = np.pad(follows, ((0, 0), (0, CLASSES - follows.shape[1]))) + SMOOTH * of_class
    pairs = (np.log(np.maximum(follows, 1e-30)) - level).astype(np.float32)
    within = np.log(SMOOTH * alone)

    def gains(pair: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.log1p(c / np.exp(within[pair % VOCABULARY]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, c = batch.column("pair").to_numpy(), batch.column("c").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(gains(pair, c))], ["pair", "gain"])

    def outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = batch.column("pair").to_numpy()
            yield batch.filter(pa.array(np.maximum(place[pair // VOCABULARY], place[pair % VOCABULARY]) == others))

    rare = materialise(counted.mapInArrow(outside, "pair long, c long"), "rare-pairs")
    top, least = _frequent(rare, FREQUENT_PAIRS)
    top = top.sort_by("pair")
    keys = top["pair"].to_numpy()
    held = gains(keys, top["c"].to_numpy()).astype(np.float32)
    rest = rare.where(F.col("c") < least).mapInArrow(rows, "pair long, gain double") if least > 1 else None
    inside = Inside(place, square.astype(np.float32), keys, held, level[:, 0].astype(np.float32), class_of, pairs)

    weights = start_weights()
    for number in range(len(rounds)):
        rate = RATE if number + 1 < len(rounds) else RATE / 3

        def local(batches: Iterator[pa.RecordBatch], weights=weights, number=number, rate=rate) -> Iterator[pa.RecordBatch]:
            steps, n = Steps(weights, pairs, class_of, rate), 0
            for batch in batches:
                for some in grouped(batch.column(0).to_pylist(), 8 * TEXTS_TOGETHER):
                    windows = spread_windows(Lines.of(some), every, number, rounds)
                    steps.take(windows, number)
                    n += len(windows)
            if n:
                # Tasks count by the windows they saw.
                flat = steps.row.astype(float) * n
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat) + 1)), pa.array(np.append(flat, n))], ["i", "v"])

        found = stored.mapInArrow(local, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
        if not len(found):
            continue
        flat = np.zeros(len(found))
        flat[found["i"].to_numpy()] = found["v"].to_numpy()
        weights = unrolled((flat[:-1] / flat[-1]).astype(np.float32), weights)
    return Model(every, class_of, pairs, inside, within, weights), rest


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` (binary, ``A-Z`` lower-cased), ``c``: how often it occurs in ``text``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            words, n = pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([words, n], ["word", "c"])

        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                held.update(text.as_py().translate(FOLD).split())
                if len(held) > WORDS_HELD:
                    yield counted()
        yield counted()

    return texts.select("text").mapInArrow(rows, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _frequent(counted: DataFrame, room: int) -> tuple[pa.Table, int]:
    """The rows from one power of two of ``c`` upwards, at most ``room``, and that power: no sort, no single task."""
    level = F.floor(F.log2("c")).cast("int")
    sizes = {r[0]: r[1] for r in counted.groupBy(level).agg(F.count("*")).collect()}
    least = max(sizes, default=-1) + 1
    while least and sizes.get(least - 1, 0) <= room:
        least -= 1
        room -= sizes.get(least, 0)
    return counted.where(F.col("c") >= 2**least).toArrow(), 2**least


def scores(docs: DataFrame, tokenizer: str, fold: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score`` for every row.

    Rows whose id's CRC-32 leaves ``fold`` modulo 5 are held out of learning;
    rows without id are learned from. A null text is empty: its only token is
    the end. Repeated rows count and are scored each. With nothing to learn
    from all shares are even; an empty table gives an empty one. Texts are
    read to their end, however long. Other columns are not read.
    """
    source = only(docs, doc_id=id_col, text=text_col).select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(id_hash() % 5 == fold, F.lit(False)).alias("held_out"),
    )
    learned = source.where("not held_out")
    counted = materialise(word_counts(learned), "word-counts")
    sums = counted.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    ends = learned.count()
    n = (sums["n"] or 0) + ends
    v = sums["v"] + (ends > 0)
    below = n + 0.5 * (v + 1)
    top, _ = _frequent(counted, FREQUENT_WORDS)
    shares = np.log10((top["c"].to_numpy() + 0.5) / below)
    frequent = dict(zip(top["word"].to_pylist(), shares.tolist()))
    end_score = math.log10((ends + 0.5) / below)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(tokenizer).coder
        look = frequent.get
        for batch in batches:
            lengths, known, sure, rare, ids = [], [], [], [], []
            for text in batch.column("text").cast(pa.binary()):
                lower = text.as_py().translate(FOLD)
                words = lower.split()
                found, rest = list(map(look, words)), []
                if None in found:
                    rest = [w for w, x in zip(words, found) if x is None]
                    found = [x for x in found if x is not None]
                lengths.append(len(words) + 1)
                known.append(len(found) + (ends > 0))
                sure.append(math.fsum(found) + end_score)
                rare.append(rest)
                ids.append(coder.encode_to_numpy(lower.decode(), disallowed_special=()).astype("<u2").tobytes() if lower else b"")
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("row", "doc_id", "held_out")],
                    pa.array(lengths, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(sure, pa.float64()),
                    pa.array(rare, pa.list_(pa.binary())),
                    pa.array(ids, pa.binary()),
                ],
                ["row", "doc_id", "held_out", "n_tokens", "known", "sure", "rare", "ids"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    figures = f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, sure double"
    numbered = source.withColumn("row", F.monotonically_increasing_id())
    judged = materialise(numbered.mapInArrow(encode, f"{figures}, rare array<binary>, ids binary"), "lm-ids")
    model, rest = learn_all(judged.where("not held_out"))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, missing = [np.zeros(0)], []
            # Some texts at a time: windows of a batch may be many.
            for some in grouped(batch.column("ids").to_pylist(), TEXTS_TOGETHER):
                lines = Lines.of(some)
                own, beyond = score_and_missing(model, lines)
                found.append(own)
                missing += beyond if joined else [None] * len(some)
            values = [pa.array(np.concatenate(found)), pa.array(missing, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *values], [*columns, "score", "missing"])

    joined = rest is not None
    columns = ["row", "doc_id", "held_out", "n_tokens", "known", "sure"]
    # Stored, so that a join planned anew on the way does not score twice.
    rated = judged.select(*columns, "ids").mapInArrow(rate, f"{figures}, score double, missing array<long>")
    scored = materialise(rated, "lm-scores")
    if joined:
        gained = scored.select("row", F.explode("missing").alias("pair")).join(rest, "pair")
        gained = gained.groupBy("row").agg((F.sum("gain") / math.log(10)).alias("gained"))
        more = F.col("score") + F.coalesce("gained", F.lit(0.0))
        scored = scored.join(gained, "row", "left").withColumn("score", more)
    rare = (
        judged.select("row", F.explode("rare").alias("word"))
        .join(counted, "word", "left")
        .groupBy("row")
        .agg(
            F.count("c").alias("rare_known"),
            F.sum(F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(below))).alias("rare_score"),
        )
    )
    return scored.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("sure") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"),
        "score",
    )
