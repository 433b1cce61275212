"""Quality classifier by co-training of two views of a document.

* The text view looks at the words alone: frequencies of hashed byte trigrams
  and how much the words repeat.
* The metadata view never looks at the words: source, language, length and
  the layout of the page (lines, cases, marks, digits).

Each view is a ridge-regularised linear classifier. It is fitted from sums
over documents (counts, sums, products per class) that Spark adds up, so every
labelled and every pseudo-labelled document takes part, and only matrices
whose size is set by the number of features reach the driver. A round scores
all documents, and each view teaches the other those without a label that it
is sure of. A view's scores are calibrated on the labelled documents by a
monotone map from score bins to shares, made from a histogram; the final score
is the sum of both log odds.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import only
from blotter.runtime import materialise

TRIGRAM_BUCKETS = 128
SOURCE_BUCKETS = 24
LANG_BUCKETS = 8
TEXT_SIZE = TRIGRAM_BUCKETS + 5
META_SIZE = SOURCE_BUCKETS + LANG_BUCKETS + 10
ROUNDS = 3
#: A view teaches documents whose calibrated probability is this sure.
SURE = 0.98
#: Only documents that are clearly worse than not go.
KEEP_FROM = 0.3
RIDGE = 1e-3
SCORE_BINS = 400
PART = 512
_WORD = re.compile(r"\S+")
_UPPER, _DIGIT, _MARK = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def text_features(text: str | None) -> np.ndarray:
    """Square roots of hashed trigram shares, and how the words repeat."""
    out = np.zeros(TEXT_SIZE, np.float32)
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return out
    b = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    code = (b[:-2] * 65599 + b[1:-1]) * 65599 + b[2:]
    code = (code * np.uint32(2654435761)) >> np.uint32(25)
    count = np.bincount(code, minlength=TRIGRAM_BUCKETS)
    out[:TRIGRAM_BUCKETS] = np.sqrt(count / count.sum())
    words = data.split()
    n = len(words)
    if n:
        distinct = len(set(words))
        out[TRIGRAM_BUCKETS:] = (
            distinct / n,
            math.log1p(n / distinct) / 4,
            sum(map(len, words)) / n / 20,
            sum(x == y for x, y in zip(words, words[1:])) / n,
            len(set(words[: n // 2]) & set(words[n // 2 :])) / distinct,
        )
    return out


def meta_features(text: str | None, source: str | None, lang: str | None) -> np.ndarray:
    """Source, language, length and layout; which words there are has no part."""
    out = np.zeros(META_SIZE, np.float32)
    out[zlib.crc32((source or "").encode()) % SOURCE_BUCKETS] = 0.2
    out[SOURCE_BUCKETS + zlib.crc32((lang or "").encode()) % LANG_BUCKETS] = 0.2
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    n = len(data)
    if n:
        lines = np.flatnonzero(data == 10)
        widths = np.diff(np.concatenate([[-1], lines, [n]]))
        marks = _MARK[data]
        pairs = marks[1:] & marks[:-1]
        out[SOURCE_BUCKETS + LANG_BUCKETS :] = (
            math.log1p(n) / 10,
            math.log1p(len(lines)) / 6,
            math.log1p(widths.mean()) / 8,
            math.log1p(widths.max()) / 10,
            np.sqrt(_UPPER[data].mean()),
            np.sqrt(_DIGIT[data].mean()),
            np.sqrt(marks.mean()),
            np.sqrt(pairs.mean()) if len(pairs) else 0,
            np.sqrt((data == 32).mean()),
            np.sqrt((data > 127).mean()),
        )
    return out


@dataclass(frozen=True)
class View:
    """A linear score and the log odds that belong to its bins."""

    weights: np.ndarray
    low: float
    high: float
    log_odds: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[:-1] + self.weights[-1]

    def bins(self, x: np.ndarray) -> np.ndarray:
        scaled = (self.score(x) - self.low) / (self.high - self.low) * SCORE_BINS
        return np.clip(scaled, 0, SCORE_BINS - 1).astype(int)

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self.log_odds[self.bins(x)]


def features(docs: DataFrame) -> DataFrame:
    """``row`` (the doc_id), ``text_x`` and ``meta_x`` (16-bit floats) per document."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            meta = zip(batch["text"], batch["source"], batch["lang"])
            yield pd.DataFrame(
                {
                    "row": batch["row"],
                    "text_x": [text_features(t).astype(np.float16).tobytes() for t in batch["text"]],
                    "meta_x": [meta_features(*r).astype(np.float16).tobytes() for r in meta],
                }
            )

    source = only(docs, row="doc_id", text="text", source="source", lang="lang")
    source = source.withColumns({c: F.col(c).cast("string") for c in ("text", "source", "lang")})
    schema = T.StructType(
        [source.schema["row"], T.StructField("text_x", T.BinaryType()), T.StructField("meta_x", T.BinaryType())]
    )
    return source.mapInPandas(rows, schema)


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float16).reshape(-1, width).astype(np.float64)


def _added(rows: DataFrame, shape: tuple[int, ...], per_batch) -> np.ndarray:
    """The sum over all rows of ``per_batch``: each task adds up its own first.

    Sums travel in parts of ``PART`` numbers, and each part is added up by itself.
    """
    size = int(np.prod(shape))

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                total += per_batch(batch).ravel()
        parts = [(i, total[i : i + PART]) for i in range(0, size, PART) if total[i : i + PART].any()]
        yield pd.DataFrame(parts, columns=["at", "v"])

    def together(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"at": parts["at"].iloc[:1], "v": [np.sum(np.stack(parts["v"]), axis=0)]})

    kind = "at long, v array<double>"
    out = np.zeros(size)
    for r in rows.mapInPandas(task, kind).groupBy("at").applyInPandas(together, kind).collect():
        out[r["at"] : r["at"] + len(r["v"])] = r["v"]
    return out.reshape(shape)


def _full(upper: np.ndarray, size: int) -> np.ndarray:
    """A symmetric matrix per class from the upper triangles."""
    out = np.zeros((2, size, size))
    i, j = np.triu_indices(size)
    out[:, i, j] = out[:, j, i] = upper.reshape(2, -1)
    return out


def _fit(sums: np.ndarray) -> np.ndarray:
    """Weights of least squares with both classes of equal weight."""
    size = sums.shape[1]
    products, target = np.zeros((size, size)), np.zeros(size)
    for c in (0, 1):
        n = max(sums[c, -1, -1], 1e-9)
        products += sums[c] / n
        target += (1 if c else -1) * sums[c, -1] / n
    return np.linalg.solve(products + RIDGE * np.eye(size), target)


def _products(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    one = np.hstack([x, np.ones((len(x), 1))])
    upper = np.triu_indices(one.shape[1])
    return np.concatenate([(one[label == c].T @ one[label == c])[upper] for c in (0, 1)])


def _calibrated(hist: np.ndarray) -> np.ndarray:
    """Log odds by bin: shares made monotone by pooling neighbours."""
    blocks: list[list[float]] = []
    prior = hist[1].sum() / max(hist.sum(), 1)
    for bad, good in hist.T:
        blocks.append([good, bad + good, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g, n, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g, blocks[-1][1] + n, blocks[-1][2] + k]
    share = np.concatenate([np.full(int(k), (g + prior) / (n + 1)) for g, n, k in blocks])
    share = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(share / (1 - share))


def _views(sums: list[np.ndarray], rows: DataFrame) -> list[View]:
    """Fit both views from ``sums`` and calibrate them on the labelled rows."""
    weights = [_fit(s) for s in sums]
    raw = [View(w, -3.0, 3.0, np.zeros(SCORE_BINS)) for w in weights]

    def histogram(batch: pd.DataFrame) -> np.ndarray:
        label = batch["label"].to_numpy().astype(int)
        out = np.zeros((2, 2, SCORE_BINS))
        for k, (x, view) in enumerate(zip(_xs(batch), raw)):
            np.add.at(out[k], (label, view.bins(x)), 1)
        return out

    hist = _added(rows.where("label is not null"), (2, 2, SCORE_BINS), histogram)
    return [View(w, -3.0, 3.0, _calibrated(h)) for w, h in zip(weights, hist)]


def _xs(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return _matrix(batch["text_x"], TEXT_SIZE), _matrix(batch["meta_x"], META_SIZE)


def labelled_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``features`` with ``label``: the rounded mean of an id's labels, or null.

    Labels without id or quality are left out; an id that comes twice in
    ``labels`` adds no rows.
    """
    known = (
        only(labels, label_id="doc_id", quality="quality")
        .where("label_id is not null and quality is not null")
        .groupBy("label_id")
        .agg(F.round(F.avg(F.col("quality").cast("double"))).alias("label"))
    )
    return rows.join(known, rows["row"] == known["label_id"], "left").drop("label_id")


def cotrain(rows: DataFrame, rounds: int = ROUNDS) -> list[View]:
    """The two views after ``rounds`` exchanges of confident pseudo-labels.

    ``rows`` are stored ``labelled_rows``. Without labels of both classes
    there is nothing to learn: the result is empty and all are kept.
    """
    t, m = TEXT_SIZE + 1, META_SIZE + 1
    cut = t * (t + 1)
    size = (cut + m * (m + 1),)

    def labelled(batch: pd.DataFrame) -> np.ndarray:
        label = batch["label"].to_numpy().astype(int)
        return np.concatenate([_products(x, label) for x in _xs(batch)])

    def split(flat: np.ndarray) -> list[np.ndarray]:
        return [_full(flat[:cut], t), _full(flat[cut:], m)]

    own = _added(rows.where("label is not null"), size, labelled)
    if not all(split(own)[0][c, -1, -1] for c in (0, 1)):
        return []
    views = _views(split(own), rows)
    sure = math.log(SURE / (1 - SURE))
    for _ in range(rounds):
        known = list(views)

        def taught(batch: pd.DataFrame, known=known) -> np.ndarray:
            xs = _xs(batch)
            odds = [v.odds(x) for v, x in zip(known, xs)]
            told = [np.where(o > sure, 1, np.where(o < -sure, 0, -1)) for o in odds]
            return np.concatenate([_products(xs[0], told[1]), _products(xs[1], told[0])])

        more = _added(rows.where("label is null"), size, taught)
        views = _views(split(own + more), rows)
    return views


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> list[View]:
    """Views learned from all of ``docs`` and their ``labels``."""
    return cotrain(materialise(labelled_rows(features(docs), labels), "quality-features"), rounds)


def verdict(views: list[View]):
    """A pandas UDF: (text, source, lang) to ``score``, both views' scores, ``keep``.

    ``score`` is the probability of good quality: the mean of the log odds of
    both views. A document is kept from ``KEEP_FROM`` on. Null and empty texts have no
    features and are judged by source and language; repeated rows get the
    same answer; without views all are kept with score 1.
    """

    @F.pandas_udf("score double, text_score double, meta_score double, keep boolean")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, source, lang in batches:
            if views and len(text):
                x = np.stack([text_features(t) for t in text]).astype(np.float16)
                y = np.stack([meta_features(*r) for r in zip(text, source, lang)]).astype(np.float16)
                a, b = views[0].odds(x.astype(np.float64)), views[1].odds(y.astype(np.float64))
            else:
                a = b = np.full(len(text), np.inf)
            both, a, b = (1 / (1 + np.exp(-z)) for z in ((a + b) / 2, a, b))
            yield pd.DataFrame({"score": both, "text_score": a, "meta_score": b, "keep": both >= KEEP_FROM})

    return judge


def judged(docs: DataFrame, views: list[View]) -> Column:
    """The verdict on each row of ``docs`` as a struct column."""
    return verdict(views)(*[F.col(f"`{c}`").cast("string") for c in ("text", "source", "lang")])
