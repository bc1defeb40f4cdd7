"""Text quality by naive Bayes support vectors.

A text is the set of its n-grams (indicators, not counts) in two alphabets: one and two words in lower case, and one
to three shapes (case and digit pattern of a word, the punctuation itself, and marks for a word that repeats the one
before it or a line that occurred before). Each indicator is scaled by its log-count ratio between the classes, as
naive Bayes would weigh it, the vector gets unit length, and a linear model with hinge loss separates the classes by
dual coordinate descent. A logistic curve through the margins of texts left out of the fit turns margins into
probabilities.

The fit uses a sample of labelled texts bounded by ``SAMPLE_PER_LABEL``; weights live in ``BUCKETS`` hashed places.
Scoring reads whole texts. A null or empty text has no n-grams and scores by the bias alone; labels other than 0 and 1
are not learned from; without both classes every score is the share of label 1 among the labelled (0.5 without any).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfacts.llm.common import appended, bounded_sample, chunks

SAMPLE_PER_LABEL = 2500
BUCKETS = 1 << 20
EPOCHS, COST, SMOOTHING = 15, 1.0, 1.0
#: Tokens a Python worker keeps the hashes of; beyond them it starts anew.
CACHE_TOKENS = 400_000
_TOKEN = re.compile(r"\n|\w+|[^\w\s]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SAME, _NEW_LINE, _OLD_LINE = 1, 2, 3


def _hash(text: str, seed: int) -> int:
    value = seed
    for b in text.encode("utf-8", "surrogatepass"):
        value = (value ^ b) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return value


def _shape(token: str) -> str:
    if not (token[0].isalnum() or token[0] == "_"):
        return token
    if token.isdigit():
        return "9"
    if token.isupper():
        return "X" if len(token) > 1 else "I"
    return "Xx" if token[0].isupper() else "x" if token.isalpha() else "x9"


class Indicators:
    """Places of the n-grams of texts; hashes of tokens are kept between texts."""

    def __init__(self) -> None:
        self._known: dict[str, int] = {}
        self._words, self._shapes = [], []

    def _number(self, token: str) -> int:
        number = len(self._words)
        self._words.append(_hash(token.lower(), 0xCBF29CE484222325))
        self._shapes.append(_hash(_shape(token), 0x84222325CBF29CE4))
        self._known[token] = number
        return number

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The distinct places of every text, one text after the other, and their number."""
        if len(self._known) > CACHE_TOKENS:
            self.__init__()
        known, number = self._known, self._number
        ids, marks, sizes = [], [], []
        for text in texts:
            tokens = _TOKEN.findall(text)
            ids += [known[t] if t in known else number(t) for t in tokens]
            sizes.append(len(tokens))
            if "\n" in text:
                lines = text.split("\n")
                marks.append(len(lines) - len(set(lines)))
            else:
                marks.append(0)
        if not ids:
            return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
        ids = np.array(ids, np.int64)
        owner = np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)
        words = np.array(self._words, np.uint64)[ids]
        shapes = np.array(self._shapes, np.uint64)[ids]
        same = np.zeros(len(ids), bool)
        same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
        shapes[same] ^= np.uint64(0x5851F42D4C957F2D)
        found = [self._grams(words, owner, 1), self._grams(words, owner, 2), *(self._grams(shapes, owner, n) for n in (1, 2, 3))]
        again = np.flatnonzero(marks).astype(np.uint64)
        found.append(again << np.uint64(32) | np.uint64(_OLD_LINE))
        distinct = np.unique(np.concatenate(found))
        return (distinct & np.uint64(0xFFFFFFFF)).astype(np.int64), np.bincount((distinct >> np.uint64(32)).astype(np.int64), minlength=len(texts))

    @staticmethod
    def _grams(codes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        if len(codes) < n:
            return np.empty(0, np.uint64)
        count = len(codes) - n + 1
        mixed = np.full(count, n, np.uint64)
        for i in range(n):
            mixed = (mixed ^ codes[i : count + i]) * _MIX
            mixed ^= mixed >> np.uint64(31)
        inside = owner[:count] == owner[n - 1 :]
        return (owner[:count] << np.uint64(32) | mixed % np.uint64(BUCKETS))[inside]


@dataclass
class Model:
    """``weights`` times log-count ratio of every place, the ratios themselves, the bias and the logistic curve."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        ends = np.concatenate([[0], np.cumsum(counts)])
        total = lambda values: np.diff(np.concatenate([[0.0], np.cumsum(values)])[ends])
        ratios = self.ratios[places].astype(np.float64)
        norms = np.sqrt(np.maximum(total(ratios**2), 1e-12))
        return total(self.weights[places] * ratios) / norms + self.bias

    def chances(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -50, 50)))


def _descend(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, costs: np.ndarray, seed: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L1 hinge loss; rows are places and values of unit vectors."""
    weights, bias = np.zeros(BUCKETS), 0.0
    alpha = np.zeros(len(rows))
    draw = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in draw.permutation(len(rows)):
            places, values = rows[i]
            slope = signs[i] * (weights[places] @ values + bias) - 1
            old = alpha[i]
            # The bias is one more coordinate of value 1, so a row's squared length is 2.
            alpha[i] = min(max(old - slope / (values @ values + 1), 0.0), costs[i])
            if (change := (alpha[i] - old) * signs[i]) != 0:
                weights[places] += change * values
                bias += change
                moved = max(moved, abs(change))
        if moved < 1e-3:
            break
    return weights, bias


def _logistic(margins: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through margins, by Newton steps on smoothed targets."""
    up, down = truth.sum(), len(truth) - truth.sum()
    target = np.where(truth == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -50, 50)))
        d, h = p - target, p * (1 - p) + 1e-9
        g = np.array([(d * margins).sum() + 1e-3 * (a - 1), d.sum()])
        m = np.array([[(h * margins**2).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-6]])
        move = np.clip(np.linalg.solve(m, g), -2, 2)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-6:
            break
    return float(a), float(b)


def train(rows: list[tuple[int, str]], share: float, seed: int = 11) -> Model:
    """A model from pairs of label (0 or 1) and text; ``share`` is the share of label 1 among all labelled rows."""
    rows = sorted(rows, key=lambda r: (r[0], r[1] or ""))
    truth = np.array([r[0] for r in rows])
    flat = np.log(share / (1 - share)) if 0 < share < 1 else 0.0 if not rows else 50.0 * (1 if share >= 1 else -1)
    if len(set(truth.tolist())) < 2:
        return Model(np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), 0.0, 0.0, flat)
    indicators = Indicators()
    places, counts = [], []
    for i in range(0, len(rows), 200):
        p, c = indicators.of([r[1] or "" for r in rows[i : i + 200]])
        places.append(p)
        counts.append(c)
    places, counts = np.concatenate(places), np.concatenate(counts)
    ends = np.cumsum(counts)
    left_out = np.random.default_rng(seed).random(len(rows)) < 0.2
    sums = []
    for k in (0, 1):
        use = np.repeat((truth == k) & ~left_out, counts)
        found = np.bincount(places[use], minlength=BUCKETS) + SMOOTHING
        sums.append(np.log(found / found.sum()))
    ratios = (sums[1] - sums[0]).astype(np.float32)
    vectors = []
    for e, c in zip(ends, counts, strict=True):
        own = places[e - c : e]
        values = ratios[own].astype(np.float64)
        vectors.append((own, values / max(np.sqrt(values @ values), 1e-6)))
    inner = np.flatnonzero(~left_out)
    signs = np.where(truth == 1, 1.0, -1.0)
    # Classes weigh as they do among all labelled rows, though the sample holds them evenly.
    weight = np.where(truth == 1, share / max((truth == 1).mean(), 1e-9), (1 - share) / max((truth == 0).mean(), 1e-9))
    weights, bias = _descend([vectors[i] for i in inner], signs[inner], COST * np.maximum(weight[inner], 0.3), seed)
    model = Model(weights.astype(np.float32), ratios, float(bias), 1.0, 0.0)
    margins = model.margins(places, counts)
    use = left_out if len(set(truth[left_out].tolist())) == 2 else ~left_out
    model.slope, model.shift = _logistic(margins[use], truth[use])
    # The curve was drawn on an even sample; shift it to the odds among all labelled rows.
    even = truth[use].mean()
    model.shift += float(flat - np.log(even / (1 - even)))
    return model


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """A model trained on a bounded sample of the rows of ``df`` with label 0 or 1 and a text."""
    usable = df.where(F.col(label).isin(0, 1) & F.col(text).isNotNull()).select(key, text, label)
    share = usable.agg(F.avg(F.col(label).cast("double"))).first()[0]
    rows = bounded_sample(usable, key, label, SAMPLE_PER_LABEL).select(label, text).collect()
    return train([(r[0], r[1]) for r in rows], 0.5 if share is None else float(share))


SCORE = T.StructField("score", T.DoubleType())


def score(df: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with ``score``, the probability of label 1. An existing column of the name is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in df.schema.fields if f.name != "score" and (keep_text or f.name != text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators, known = Indicators(), shared.value
        for part, texts in chunks(batches, text):
            chances = known.chances(known.margins(*indicators.of(texts)))
            yield appended(part, {"score": pa.array(chances)}).select([f.name for f in kept] + ["score"])

    return df.mapInArrow(run, T.StructType([*kept, SCORE]))
