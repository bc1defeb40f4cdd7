"""Language of the words of a text by a linear-chain conditional random field, and of the text from its words.

A word's features are its character n-grams (two to four characters, with marks at both ends, so that those touching
a mark are its affixes), and its entry in a lexicon of the training words. Their weights add up to a score per label;
learned transitions couple neighbouring words, so that a short or ambiguous word follows its surroundings and a run of
words in another language is still seen. Forward-backward gives each word's probabilities; a text has the label with
the largest sum of them, and the mean probability of that label over its words is the score.

The field is trained here, on a sample bounded by ``SAMPLE_PER_LABEL`` texts per label: stretches of texts in
different languages are spliced, which gives sequences whose true switches are known. Training maximises the
conditional likelihood by AdaGrad.

Words are runs of letters (and of the numerals among them that are no digits) in lower case, with a letter at least. A
text that is null, empty or has no letter has the label ``und`` and score 0. Of labels with equal sums the first in code
point order is taken; repeated rows are labelled one by one, and an empty table gives an empty result. Texts are read
whole, whatever their length: training takes word windows from all over a long text.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfacts.llm.common import appended, bounded_sample, chunks

UNKNOWN = "und"
#: Bounds of the training sample: texts per label, words of a text and the windows they come from, spliced sequences.
SAMPLE_PER_LABEL, SAMPLE_WORDS, WINDOWS, SEQUENCES, SEQUENCE_WORDS = 500, 400, 8, 2400, 32
EPOCHS, RATE, DECAY = 4, 0.3, 1e-6
_BUCKETS = 1 << 17
_LENGTHS = (2, 3, 4)
#: Words a Python worker keeps the scores of; beyond them it starts anew.
CACHE_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    found = _WORD.findall(text.lower())
    return [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


def sampled_words(text: str) -> list[str]:
    """At most ``SAMPLE_WORDS`` words of a text: of a longer one a window from each of ``WINDOWS`` equal stretches."""
    words = words_of(text)
    if len(words) <= SAMPLE_WORDS:
        return words
    draw, size = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass"))), SAMPLE_WORDS // WINDOWS
    edges = [i * len(words) // WINDOWS for i in range(WINDOWS + 1)]
    begins = [draw.randrange(a, max(a + 1, b - size + 1)) for a, b in zip(edges, edges[1:], strict=False)]
    return [w for begin in begins for w in words[begin : begin + size]]


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words one after the other, and the number of each word (never zero)."""
    codes = np.frombuffer("".join(f"\1{w}\2" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    hashes, owners = [], []
    for n in _LENGTHS:
        if len(codes) < n:
            continue
        mixed = np.full(len(codes) - n + 1, n, np.uint64)
        for i in range(n):
            mixed = (mixed ^ codes[i : len(codes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        inside = owner[: len(mixed)] == owner[n - 1 :]
        hashes.append((mixed[inside] % np.uint64(_BUCKETS)).astype(np.int64))
        owners.append(owner[: len(mixed)][inside])
    flat, whose = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(whose, kind="stable")
    return flat[order], np.bincount(whose, minlength=len(words))


@dataclass
class Field:
    """Weights of the features, of the lexicon's words, and of the transitions."""

    labels: list[str]
    weights: np.ndarray
    lexicon: dict[str, np.ndarray]
    start: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of distinct words, a row each."""
        flat, counts = _features(words)
        scores = np.add.reduceat(self.weights[flat], np.cumsum(counts) - counts, axis=0)
        scores /= np.sqrt(counts)[:, None]
        for i, w in enumerate(words):
            if w in self.lexicon:
                scores[i] += self.lexicon[w]
        return scores


def forward_backward(emissions: np.ndarray, counts: np.ndarray, start: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Label probabilities of every word. ``emissions`` holds the sequences one after the other.

    All sequences advance together, longest first, so that a step works on those that are still running.
    """
    total, labels = emissions.shape
    order = np.argsort(-counts, kind="stable")
    lengths = counts[order]
    begins = (np.cumsum(counts) - counts)[order]
    running = np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(lengths) else 0), side="left")
    local = np.exp(emissions - emissions.max(axis=1, keepdims=True)).astype(np.float64) + 1e-30
    step = np.exp(transitions - transitions.max())
    forward = np.empty((total, labels))
    alpha = np.tile(np.exp(start - start.max()), (len(counts), 1))
    for t, n in enumerate(running):
        at = begins[:n] + t
        alpha = (alpha[:n] @ step if t else alpha[:n]) * local[at]
        alpha /= alpha.sum(axis=1, keepdims=True)
        forward[at] = alpha
    beta = np.ones((0, labels))
    for t in range(len(running) - 1, -1, -1):
        n = running[t]
        if n > len(beta):
            beta = np.concatenate([beta, np.ones((n - len(beta), labels))])
        at = begins[:n] + t
        forward[at] *= beta
        beta = (beta * local[at]) @ step.T
        beta /= beta.sum(axis=1, keepdims=True)
    return forward / forward.sum(axis=1, keepdims=True)


def _spliced(texts: list[tuple[str, list[str]]], seed: int) -> list[tuple[list[str], list[str]]]:
    """Sequences of stretches from texts in different languages: words and their labels."""
    draw = random.Random(seed)
    made = []
    for _ in range(SEQUENCES):
        words, labels = [], []
        while len(words) < SEQUENCE_WORDS:
            label, text = texts[draw.randrange(len(texts))]
            n = draw.randint(2, SEQUENCE_WORDS)
            begin = draw.randrange(max(1, len(text) - n + 1))
            words += text[begin : begin + n]
            labels += [label] * len(text[begin : begin + n])
        made.append((words[:SEQUENCE_WORDS], labels[:SEQUENCE_WORDS]))
    return made


def train(rows: list[tuple[str, str]], seed: int = 7) -> Field:
    """A field from pairs of label and text. Labels are balanced; with no usable text it knows no label."""
    by_label: dict[str, list[list[str]]] = {}
    for label, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        if found := sampled_words(text or ""):
            by_label.setdefault(label, []).append(found)
    labels = sorted(by_label)
    size = len(labels)
    field = Field(labels, np.zeros((_BUCKETS, size), np.float32), {}, np.zeros(size), np.zeros((size, size)))
    if size < 2:
        return field
    # The lexicon: words that occur in several training texts, with smoothed log shares of the labels.
    seen = [Counter(w for text in by_label[label] for w in set(text)) for label in labels]
    for word in {w for c in seen for w, n in c.items() if n >= 3}:
        shares = np.array([(c[word] + 0.2) / (len(by_label[label]) + 1) for c, label in zip(seen, labels, strict=True)])
        logs = np.log(shares)
        field.lexicon[word] = (0.5 * (logs - logs.mean())).astype(np.float32)
    draw = random.Random(seed)
    balanced = [(label, draw.choice(by_label[label])) for label in labels for _ in range(SAMPLE_PER_LABEL)]
    sequences = _spliced(balanced, seed)
    vocabulary = sorted({w for words, _ in sequences for w in words})
    number = {w: i for i, w in enumerate(vocabulary)}
    flat, counts = _features(vocabulary)
    begins = np.cumsum(counts) - counts
    fixed = np.array([field.lexicon.get(w, np.zeros(size)) for w in vocabulary])
    squares = [np.full((_BUCKETS, size), 1e-6), np.full(size, 1e-6), np.full((size, size), 1e-6)]
    ids = np.array([[number[w] for w in words] for words, _ in sequences])
    truth = np.array([[labels.index(x) for x in own] for _, own in sequences])
    batch, length = 64, SEQUENCE_WORDS
    for epoch in range(EPOCHS):
        order = np.random.default_rng(seed + epoch).permutation(len(ids))
        for first in range(0, len(order), batch):
            part = order[first : first + batch]
            words, inverse = np.unique(ids[part].ravel(), return_inverse=True)
            own = counts[words]
            features = flat[np.repeat(begins[words] - (np.cumsum(own) - own), own) + np.arange(own.sum())]
            scale = 1 / np.sqrt(own)
            sums = np.add.reduceat(field.weights[features], np.cumsum(own) - own, axis=0) * scale[:, None] + fixed[words]
            scores = sums[inverse]
            n = len(part)
            chance = forward_backward(scores, np.full(n, length), field.start, field.transitions)
            # Pair probabilities follow from one step of the messages on both sides of each transition.
            pair = _pair_counts(scores.reshape(n, length, size), field)
            right = np.eye(size)[truth[part]]
            error = chance - right.reshape(-1, size)
            per_word = np.zeros((len(words), size))
            np.add.at(per_word, inverse, error)
            spread = np.repeat(per_word * scale[:, None], own, axis=0)
            touched, place = np.unique(features, return_inverse=True)
            slope = np.stack([np.bincount(place, spread[:, k], len(touched)) for k in range(size)], axis=1) / n
            slope += DECAY * field.weights[touched]
            squares[0][touched] += slope**2
            field.weights[touched] -= (RATE * slope / np.sqrt(squares[0][touched])).astype(np.float32)
            seen_pairs = np.einsum("nti,ntj->ij", right[:, :-1], right[:, 1:])
            for i, (value, slope) in enumerate(
                ((field.start, (chance.reshape(n, length, size)[:, 0] - right[:, 0]).sum(0) / n), (field.transitions, (pair - seen_pairs) / n)), 1
            ):
                squares[i] += slope**2
                value -= RATE * slope / np.sqrt(squares[i])
    return field


def _pair_counts(scores: np.ndarray, field: Field) -> np.ndarray:
    """Expected transitions over sequences of equal length."""
    n, length, size = scores.shape
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(field.transitions - field.transitions.max())
    alpha, beta = np.empty_like(local), np.ones_like(local)
    alpha[:, 0] = np.exp(field.start - field.start.max()) * local[:, 0]
    for t in range(1, length):
        alpha[:, t] = (alpha[:, t - 1] @ step) * local[:, t]
        alpha[:, t] /= alpha[:, t].sum(1, keepdims=True)
    for t in range(length - 2, -1, -1):
        beta[:, t] = (beta[:, t + 1] * local[:, t + 1]) @ step.T
        beta[:, t] /= beta[:, t].sum(1, keepdims=True)
    total = np.zeros((size, size))
    for t in range(length - 1):
        both = alpha[:, t, :, None] * step * (beta[:, t + 1] * local[:, t + 1])[:, None, :]
        total += (both / both.sum(axis=(1, 2), keepdims=True)).sum(0)
    return total


class Labeller:
    """A field with the scores of the words met so far."""

    def __init__(self, field: Field):
        self.field = field
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._scores = np.empty((1 << 14, len(self.field.labels)), np.float32)

    def _learn(self, rows: list[list[str]]) -> None:
        if len(self._known) > CACHE_WORDS:
            self._forget()
        new = [w for w in set().union(*rows) if w not in self._known]
        for begin in range(0, len(new), 20_000):
            part = new[begin : begin + 20_000]
            first = len(self._known)
            while first + len(part) > len(self._scores):
                self._scores = np.concatenate([self._scores, np.empty_like(self._scores)])
            self._scores[first : first + len(part)] = self.field.emissions(part)
            self._known.update(zip(part, range(first, first + len(part)), strict=True))

    def chances(self, rows: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of the words of all rows one after the other, and the number of each row."""
        self._learn(rows)
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        known = self._known
        ids = np.fromiter((known[w] for row in rows for w in row), np.int64, int(counts.sum()))
        return forward_backward(self._scores[ids], counts, self.field.start, self.field.transitions), counts


#: Texts scored together, in characters: the longest of them sets the number of steps.
_TOGETHER = 1 << 20


def _many(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[list[pa.RecordBatch], list[str]]]:
    parts, texts, size = [], [], 0
    for part, own in chunks(batches, text):
        parts.append(part)
        texts += own
        size += sum(map(len, own))
        if size >= _TOGETHER:
            yield parts, texts
            parts, texts, size = [], [], 0
    if parts:
        yield parts, texts


SPAN = T.StructType([T.StructField("label", T.StringType()), T.StructField("n_words", T.IntegerType())])
FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
SPANS = T.StructField("lang_spans", T.ArrayType(SPAN))
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("n_words", pa.int32())]))


def _runs(best: np.ndarray, labels: list[str]) -> list[dict]:
    if not len(best):
        return []
    edges = np.concatenate([[0], np.flatnonzero(np.diff(best)) + 1, [len(best)]])
    return [{"label": labels[best[a]], "n_words": int(b - a)} for a, b in zip(edges, edges[1:], strict=False)]


def label(df: DataFrame, field: Field, text: str = "text", spans: bool = False, keep_text: bool = True) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, and with ``spans`` the runs of words in one language.

    Existing columns of these names are replaced."""
    shared = df.sparkSession.sparkContext.broadcast(field)
    new = [*FIELDS, *([SPANS] if spans else [])]
    names = {f.name for f in new}
    kept = [f for f in df.schema.fields if f.name not in names and (keep_text or f.name != text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        labels = labeller.field.labels
        for parts, texts in _many(batches, text):
            rows = [words_of(t) for t in texts]
            if not labels:
                rows = [[] for _ in texts]
            chances, counts = labeller.chances(rows) if any(rows) else (np.empty((0, max(1, len(labels)))), np.zeros(len(rows), int))
            ends = np.cumsum(counts)
            sums = np.concatenate([np.zeros((1, chances.shape[1])), np.cumsum(chances, axis=0)])
            mass = sums[ends] - sums[ends - counts]
            best = mass.argmax(axis=1)
            some = counts > 0
            means = np.where(some, mass.max(axis=1) / np.maximum(counts, 1), 0.0).clip(0, 1)
            pred = [labels[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
            tops = chances.argmax(axis=1) if spans else None
            begin = 0
            for part in parts:
                stop = begin + part.num_rows
                made = {"lang_pred": pa.array(pred[begin:stop], pa.string()), "score": pa.array(means[begin:stop])}
                if spans:
                    own = [_runs(tops[e - c : e], labels) for e, c in zip(ends[begin:stop], counts[begin:stop], strict=True)]
                    made["lang_spans"] = pa.array(own, _SPANS)
                yield appended(part, made).select([f.name for f in kept] + [f.name for f in new])
                begin = stop

    return df.mapInArrow(run, T.StructType([*kept, *new]))


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Field:
    """A field trained on a bounded sample of the rows of ``df`` that have a label and a text."""
    usable = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(key, text, lang)
    rows = bounded_sample(usable, key, lang, SAMPLE_PER_LABEL).select(F.col(lang).alias("label"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            yield appended(part, {"text": pa.array([" ".join(sampled_words(t)) for t in texts], pa.string())})

    # The windows are cut in the tasks: what training does not use of a long text does not reach the driver.
    return train([(r[0], r[1]) for r in rows.mapInArrow(run, "label string, text string").collect()])
