"""Byte-level BPE: pre-tokenisation by scans over codepoint classes, cached pair merging, decoding.

The split pattern is the one of the public byte-level tokenizers::

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Instead of a regular expression, every codepoint becomes one of nine symbols (its class, with one codepoint of
look-ahead for white space and two for contractions). A symbol is a transition function on eight states. Functions
compose associatively, so the texts are laid out in equal blocks: all blocks compose their functions side by side, a
scan over the blocks gives each its entry state, and a second pass marks where a slice begins. The different slices are
found by an Arrow dictionary over the bytes of the texts, looked up in a bounded cache and merged pair by pair, lowest
rank first, where they are new.

Null and empty texts have no tokens and decode to empty bytes. Texts of any length are processed whole.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import accumulate, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickfacts.llm.common import appended, chunks

#: States: B nothing open, L/N/O run of letters, digits or others, S a space that joins what follows, R white space,
#: C1/C2 one or two letters of a contraction to come.
B, L, N, O, S, R, C1, C2 = range(8)
#: Symbols: classes; a last space or other white space before something else; white space before white space or the
#: end; an apostrophe that begins a contraction of one or two letters; the end of a text.
LETTER, DIGIT, OTHER, LAST_SPACE, LAST_BLANK, BLANK, SHORT, LONG, END = range(9)
_BLOCK = 256
#: Merged slices and their tokens a Python worker keeps; beyond either it starts anew.
CACHE_SLICES, CACHE_TOKENS = 400_000, 1 << 22


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a slice begins here", both by symbol * 8 + state."""
    step, begins = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    constant = {DIGIT: N, OTHER: O, LAST_SPACE: S, LAST_BLANK: B, BLANK: R, END: B}
    for symbol, state in constant.items():
        step[symbol] = state
    step[LETTER] = L
    step[LETTER, C2], step[LETTER, C1] = C1, B
    begins[LETTER, [L, S, C1, C2]] = False
    begins[DIGIT, [N, S]] = False
    begins[BLANK, R] = False
    for symbol, state in ((SHORT, C1), (LONG, C2), (OTHER, O)):
        step[symbol] = state
        step[symbol, [O, S]] = O
        begins[symbol, [O, S]] = False
    return step.ravel(), begins.ravel()


_STEP, _BEGINS = _automaton()


# Letters and numbers new in Unicode 16, which tokenizer libraries know and Python's table may not.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Symbol of every codepoint by itself: letters, digits, white space (as BLANK), others."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        first = unicodedata.category(chr(code))[0]
        if first == "L":
            kinds[code] = LETTER
        elif first == "N":
            kinds[code] = DIGIT
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, DIGIT)):
        for low, high in ranges:
            kinds[low : high + 1] = kind
    # The codepoints with the property White_Space.
    blanks = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    kinds[blanks] = BLANK
    return kinds


def _symbols(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of the codepoints of several texts, each closed by one codepoint at ``ends``."""
    symbols = _classes()[codes]
    symbols[ends] = END
    blank = symbols == BLANK
    last = blank.copy()
    last[:-1] &= ~blank[1:] & (symbols[1:] != END)
    last[-1:] = False
    symbols[last] = LAST_BLANK
    symbols[last & (codes == 0x20)] = LAST_SPACE
    marks = np.flatnonzero((codes == 0x27) & (symbols == OTHER))
    if len(marks):
        padded = np.append(codes, [0, 0])
        one, two = padded[marks + 1], padded[marks + 2]
        of = lambda letters: [ord(c) for c in letters]
        symbols[marks[np.isin(one, of("stmd"))]] = SHORT
        pair = one.astype(np.int64) << 32 | two
        symbols[marks[np.isin(pair, [ord(p[0]) << 32 | ord(p[1]) for p in ("re", "ve", "ll")])]] = LONG
    return symbols


def slice_starts(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions at which a slice or the closing codepoint of a text begins."""
    n = len(codes)
    blocks = -(-n // _BLOCK)
    symbols = np.full(blocks * _BLOCK, END, np.uint8)
    symbols[:n] = _symbols(codes, ends)
    grid = np.ascontiguousarray(symbols.reshape(blocks, _BLOCK).T).astype(np.uint8) * 8
    composed = np.repeat(np.arange(8, dtype=np.uint8)[:, None], blocks, axis=1)
    for i, row in enumerate(grid):
        composed = _STEP[composed + row]
        # Once every composition is constant, one state stands for all eight.
        if len(composed) > 1 and i % 8 == 7 and (composed == composed[0]).all():
            composed = composed[:1]
    composed = np.broadcast_to(composed, (8, blocks))
    entry = np.fromiter(accumulate(composed.T.tolist()[:-1], lambda s, f: f[s], initial=B), np.uint8, blocks)
    begins = np.empty((_BLOCK, blocks), bool)
    state = entry
    for i, row in enumerate(grid):
        at = state + row
        begins[i] = _BEGINS[at]
        state = _STEP[at]
    return np.flatnonzero(begins.T.ravel()[:n])


class Slices:
    """The slices of several texts: where each begins in their joined bytes, and how many a text has."""

    def __init__(self, texts: list[str]):
        joined = "\0".join([*texts, ""])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.fromiter(accumulate(len(t) + 1 for t in texts), np.int64, len(texts)) - 1
        starts = slice_starts(codes, ends)
        closing = np.searchsorted(starts, ends)
        self.per_text = np.diff(closing, prepend=-1) - 1
        self._real = np.ones(len(starts), bool)
        self._real[closing] = False
        self._data = joined.encode("utf-8", "surrogatepass")
        # The byte of every codepoint: all bytes but those that continue one.
        places = np.flatnonzero((np.frombuffer(self._data, np.uint8) & 0xC0) != 0x80)
        self._cuts = places[starts]
        self._firsts = places[np.append(0, ends[:-1] + 1)] if len(ends) else ends

    def byte_starts(self) -> np.ndarray:
        """The byte of its text, in UTF-8, at which every slice begins."""
        return self._cuts[self._real] - np.repeat(self._firsts, self.per_text)

    def distinct(self) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """The different slices in UTF-8, and for every slice which of them it is; the closing codepoint is among them."""
        if not self._real.any():
            return pa.array([], pa.large_binary()), np.empty(0, np.int64)
        # Slices and closing codepoints follow each other without gaps.
        offsets = np.append(self._cuts, len(self._data))
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(self._data)]
        found = pa.Array.from_buffers(pa.large_binary(), len(self._cuts), buffers).dictionary_encode()
        return found.dictionary, found.indices.to_numpy(zero_copy_only=False)[self._real]


def _stretches(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of stretches that begin at ``starts``, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that begin at ``starts``, one after the other."""
    return flat[_stretches(starts, lengths)]


def _totals(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over consecutive runs of ``counts`` values."""
    running = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return running[ends] - running[ends - counts]


class Vocabulary:
    """Ranks of a vocabulary file with base64 tokens, and the cache of merged slices."""

    def __init__(self, content: bytes):
        lines = (line.split() for line in content.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.none = max(self.ranks.values()) + 1
        tokens = [b""] * self.none
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.byte_counts = np.fromiter(map(len, tokens), np.int64, self.none)
        self.byte_starts = np.cumsum(self.byte_counts) - self.byte_counts
        self._single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self._hash_pairs()
        #: The token that two bytes make.
        self._first = self._joined(np.repeat(self._single, 256), np.tile(self._single, 256)).reshape(256, 256)
        self._forget()

    def _hash_pairs(self) -> None:
        """From a pair of tokens to the token it makes, for one pair; open-addressed for look-ups of whole arrays."""
        ranks = self.ranks
        pairs = {
            (ranks[token[:i]] << 32 | ranks[token[i:]]): rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self._made_by = pairs
        self._bits = max(4, int(len(pairs) * 3).bit_length())
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._made = np.full(1 << self._bits, self.none, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        made = np.fromiter(pairs.values(), np.int32, len(pairs))
        at = self._slot(keys)
        while len(keys):
            free = self._keys[at] == -1
            # Of several keys for one free slot the last written stays; the others move on.
            self._keys[at[free]] = keys[free]
            placed = self._keys[at] == keys
            self._made[at[placed]] = made[placed]
            keys, made, at = keys[~placed], made[~placed], (at[~placed] + 1) & ((1 << self._bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token each pair makes; ``none`` where it makes none."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slot(keys)
        made = np.full(len(keys), self.none, np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            seen = self._keys[at[open_]]
            hit = seen == keys[open_]
            made[open_[hit]] = self._made[at[open_[hit]]]
            open_ = open_[~hit & (seen != -1)]
            at[open_] = (at[open_] + 1) & ((1 << self._bits) - 1)
        return made

    def _forget(self) -> None:
        """Empty the cache: slice -> number, and by number where its tokens lie."""
        self._known: dict[bytes, int] = {}
        self._flat, self._used = np.empty(1 << 16, np.int32), 0
        self._starts, self._counts = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def _keep(self, pieces: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        first, n, total = len(self._known), len(pieces), len(ids)
        while self._used + total > len(self._flat):
            self._flat = np.concatenate([self._flat, np.empty_like(self._flat)])
        while first + n > len(self._starts):
            self._starts = np.concatenate([self._starts, np.empty_like(self._starts)])
            self._counts = np.concatenate([self._counts, np.empty_like(self._counts)])
        self._flat[self._used : self._used + total] = ids
        self._starts[first : first + n] = self._used + np.cumsum(counts) - counts
        self._counts[first : first + n] = counts
        self._used += total
        self._known.update(zip(pieces, range(first, first + n), strict=True))

    def merge(self, piece: bytes) -> list[int]:
        """Tokens of one slice: the adjacent pair of lowest rank is joined, leftmost first, until none is known.

        Open pairs wait in a heap by rank and place and the parts are a linked list, so a run of n bytes without a
        boundary takes n log n steps. Entries of pairs that have changed since are passed over."""
        n, none, tokens = len(piece), self.none, self._single[np.frombuffer(piece, np.uint8)]
        scores = np.append(self._joined(tokens[:-1], tokens[1:]), none).tolist()
        heap = [score << 32 | i for i, score in enumerate(scores) if score < none]
        heapify(heap)
        ids, before, behind = tokens.tolist(), list(range(-1, n - 1)), list(range(1, n + 1))
        made = self._made_by.get
        while heap:
            best = heappop(heap)
            score, i = best >> 32, best & 0xFFFFFFFF
            if scores[i] != score:
                continue
            gone = behind[i]
            ids[i], ids[gone], scores[gone] = score, -1, none
            right = behind[i] = behind[gone]
            scores[i] = none
            if right < n:
                before[right] = i
                if (joined := made(score << 32 | ids[right], none)) < none:
                    scores[i] = joined
                    heappush(heap, joined << 32 | i)
            left = before[i]
            if left >= 0:
                scores[left] = joined = made(ids[left] << 32 | score, none)
                if joined < none:
                    heappush(heap, joined << 32 | left)
        return [t for t in ids if t >= 0]

    def merge_all(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of many slices of similar length at once: a row each, one pair joined per row and round. A slice is
        ``lengths`` bytes of ``data`` from ``starts`` on.

        Returns the tokens of all slices one after the other, and their numbers."""
        none = self.none
        width = int(lengths.max())
        columns = np.arange(width)
        raw = np.zeros((len(lengths), width), np.uint8)
        raw[columns < lengths[:, None]] = _gather(data, starts, lengths)
        tokens = self._single[raw]
        out, counts, lengths = tokens.copy(), lengths.copy(), lengths.copy()
        # One column more than pairs: it stays without a token and moves in from the right.
        scores = np.full((len(lengths), width), none, np.int32)
        pairs = columns[:-1] < (lengths - 1)[:, None]
        scores[:, :-1][pairs] = self._first[raw[:, :-1][pairs], raw[:, 1:][pairs]]
        rows = np.arange(len(lengths))
        while True:
            at = scores.argmin(axis=1)
            best = scores[np.arange(len(at)), at]
            go = best < none
            if not go.all():
                out[rows[~go]], counts[rows[~go]] = tokens[~go], lengths[~go]
                rows, tokens, scores, lengths, at, best = rows[go], tokens[go], scores[go], lengths[go], at[go], best[go]
            if not len(rows):
                break
            every = np.arange(len(rows))
            behind = columns[:-1] > at[:, None]
            np.copyto(tokens[:, :-1], tokens[:, 1:].copy(), where=behind)
            np.copyto(scores[:, :-1], scores[:, 1:].copy(), where=behind)
            tokens[every, at] = best
            lengths -= 1
            scores[every, at] = none
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < lengths - 1)
            fresh = np.concatenate([left, right])
            place = np.concatenate([at[left] - 1, at[right]])
            scores[fresh, place] = self._joined(tokens[fresh, place], tokens[fresh, place + 1])
        return out[columns < counts[:, None]], counts

    def _numbers(self, pieces: pa.LargeBinaryArray) -> np.ndarray:
        """Numbers of different slices in the cache; those it lacks are merged first, those of like length together."""
        if len(self._known) > CACHE_SLICES or self._used > CACHE_TOKENS:
            self._forget()
        if not len(pieces):
            return np.empty(0, np.int64)
        _, offsets, data = pieces.buffers()
        offsets = np.frombuffer(offsets, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
        whole, places = data.to_pybytes(), offsets.tolist()
        keys = [whole[i:j] for i, j in pairwise(places)]
        numbers = np.fromiter(map(self._known.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(numbers < 0)
        data, lengths = np.frombuffer(whole, np.uint8), np.diff(offsets)
        widths = -(-lengths[new] // 4)
        for width in np.unique(widths).tolist():
            found = new[widths == width]
            step = 4096 if width <= 16 else 1
            for start in range(0, len(found), step):
                part = found[start : start + step]
                own = [keys[i] for i in part.tolist()]
                numbers[part] = len(self._known) + np.arange(len(part))
                if width <= 16:
                    self._keep(own, *self.merge_all(data, offsets[part], lengths[part]))
                else:
                    ids = self.merge(own[0])
                    self._keep(own, np.array(ids, np.int32), np.array([len(ids)]))
        return numbers

    def _coded(self, texts: list[str]) -> tuple[Slices, np.ndarray, np.ndarray, np.ndarray]:
        slices = Slices(texts)
        pieces, which = slices.distinct()
        numbers = self._numbers(pieces)[which]
        counts = self._counts[numbers]
        return slices, _gather(self._flat, self._starts[numbers], counts), counts, _totals(counts, slices.per_text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts one after the other, and the number of each text."""
        _, ids, _, counts = self._coded(texts)
        return ids, counts

    def encode_at(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of all texts, the byte of its text at which each begins, and the number of each text.

        A token lies where its slice was cut from the text, plus the tokens before it in the slice."""
        slices, ids, own, counts = self._coded(texts)
        sizes = self.byte_counts[ids]
        before = np.cumsum(sizes) - sizes
        inside = before - np.repeat(before[np.cumsum(own) - own], own)
        return ids, np.repeat(slices.byte_starts(), own) + inside, counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts one after the other, and the number of each text, from their tokens."""
        sizes = self.byte_counts[ids]
        return _gather(self.bytes, self.byte_starts[ids], sizes), _totals(sizes, counts)

    def decode_at(self, ids: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``decode``, with the bytes of every token put at its own offset in the text.

        A text ends where the last of its tokens does; offsets that leave a gap or lay tokens over each other are an
        error."""
        sizes = self.byte_counts[ids]
        totals = _totals(sizes, counts)
        first = np.repeat(np.cumsum(totals) - totals, counts)
        places = _stretches(first + starts, sizes)
        if len(places) and (int(places.min()) < 0 or int(places.max()) >= len(places)):
            raise ValueError("a token lies outside its text")
        out, filled = np.empty(len(places), np.uint8), np.zeros(len(places), bool)
        out[places] = _gather(self.bytes, self.byte_starts[ids], sizes)
        filled[places] = True
        if not filled.all():
            raise ValueError("token offsets leave a gap")
        return out, totals


@lru_cache(maxsize=2)
def _read(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file this machine holds."""
    with open(path, "rb") as file:
        return _read(file.read())


class Ranks:
    """A vocabulary file, read where the driver runs and broadcast (its size is that of the vocabulary, a few MB).

    Executors need no copy of the file; ``get`` gives a task the vocabulary, built once per Python worker."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as file:
            self._content = spark.sparkContext.broadcast(file.read())

    def get(self) -> Vocabulary:
        return _read(self._content.value)


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(_offsets(counts)), pa.array(values.astype(np.int32)))


def _binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(_offsets(counts)), pa.py_buffer(np.ascontiguousarray(values, np.uint8))]
    return pa.Array.from_buffers(pa.binary(), len(counts), buffers)


def _schema(df: DataFrame, *fields: T.StructField) -> T.StructType:
    new = {f.name for f in fields}
    return T.StructType([*(f for f in df.schema.fields if f.name not in new), *fields])


IDS = T.StructField("token_ids", T.ArrayType(T.IntegerType()))
STARTS = T.StructField("token_starts", T.ArrayType(T.IntegerType()))
DECODED = T.StructField("decoded", T.BinaryType())


def encode(df: DataFrame, path: str, text: str = "text", offsets: bool = False) -> DataFrame:
    """``df`` with ``token_ids``, and with ``offsets`` also ``token_starts``: the byte at which each token begins."""
    ranks = Ranks(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ranks.get()
        for part, texts in chunks(batches, text):
            if offsets:
                ids, starts, counts = known.encode_at(texts)
                new = {"token_ids": _lists(ids, counts), "token_starts": _lists(starts, counts)}
            else:
                ids, counts = known.encode(texts)
                new = {"token_ids": _lists(ids, counts)}
            yield appended(part, new)

    return df.mapInArrow(run, _schema(df, IDS, *([STARTS] if offsets else [])))


def decode(df: DataFrame, path: str, ids: str = "token_ids", starts: str | None = None) -> DataFrame:
    """``df`` with ``decoded``: the bytes of the tokens, put at the offsets in ``starts`` where it is given.

    A null array decodes to empty bytes."""
    ranks = Ranks(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ranks.get()
        flat = lambda rows: rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = part.column(part.schema.get_field_index(ids))
                counts = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                if starts:
                    places = flat(part.column(part.schema.get_field_index(starts)))
                    yield appended(part, {"decoded": _binaries(*known.decode_at(flat(rows), places, counts))})
                else:
                    yield appended(part, {"decoded": _binaries(*known.decode(flat(rows), counts))})

    return df.mapInArrow(run, _schema(df, DECODED))


def round_trip(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` without the text, with ``token_ids``, ``token_starts`` and what they decode to, in one pass of the Python
    workers. A null text counts as empty. Existing columns of these names are replaced."""
    ranks = Ranks(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ranks.get()
        for part, texts in chunks(batches, text):
            ids, starts, counts = known.encode_at(texts)
            decoded = _binaries(*known.decode_at(ids, starts, counts))
            new = {"token_ids": _lists(ids, counts), "token_starts": _lists(starts, counts), "decoded": decoded}
            yield appended(part.drop_columns([text]), new)

    return df.mapInArrow(run, _schema(df.drop(text), IDS, STARTS, DECODED))
