"""Secrets in texts: fixed patterns, and what a linear-chain conditional random field adds.

Three patterns always count. Beside them each text is cut into tokens (words, and signs one by one), and a
conditional random field tags them as begin of a secret, inside one, or outside. Its features are the
token's shape and those beside it, the words around it, whether it touches its neighbours, and the make-up
of the whole text. It learns from a bounded sample of texts whose labels are the patterns' own finds; on
shapes and words rather than on the patterns, and once more with either of them hidden, so it also finds
what the patterns don't spell out. Viterbi decoding gives the tags. Tokens that the best path can't tag as a
secret are settled beforehand (``_surely_outside``), and the rest is decoded run by run, with the same result.

Spans are the whole match of a pattern, or the tokens of a tagged secret of at least ``LEAST`` characters
that shares no character with a pattern's; places are code points, end exclusive.

Cases. A null text is empty and has no spans. Texts of any length are scanned whole, as one sequence each.
Each row is scanned, repeated ones alike; null doc_ids too. Spans of the same place are ordered by kind.
Where the sample holds no secret, patterns alone count. An empty table gives no rows. Only doc_id and text
are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.columns import slices, text_bytes
from cardlake.llm.common import mix64

KINDS = ("assign", "access", "hex", "tagged")
#: Characters of a tagged secret.
LEAST = 8
#: Texts that the sample of the field holds at most, windows taken from them, tokens on each side.
SAMPLE, WINDOWS, BESIDE = 20_000, 2_000, 16
ROUNDS = 60
SLICE_BYTES = 4 << 20

_ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_BEGINNINGS = (b"passw", b"secret", b"token", b"api")
_OUT, _BEGIN, _IN = 0, 1, 2


# Patterns ----------------------------------------------------------------------------------------------


def _places(data: bytes, sought: bytes) -> Iterator[int]:
    at = data.find(sought)
    while at >= 0:
        yield at
        at = data.find(sought, at + 1)


def _hex_runs(codes: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(codes) + 2, dtype=np.int8)
    inside[1:-1] = ((codes >= 48) & (codes <= 57)) | ((codes >= 97) & (codes <= 102))
    edge = np.flatnonzero(np.diff(inside))
    runs = edge.reshape(-1, 2)
    return runs[runs[:, 1] - runs[:, 0] >= 32]


def pattern_spans(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end, kind) of all matches in order, and (start, end) of the secrets in them.

    Places are bytes. All signs of the patterns are ASCII, so bytes match as characters do. A match of the
    first pattern can only begin where one of its words does; those places are found first.
    """
    data = codes.tobytes()
    spans, values = [], []
    folded, last = data.lower(), 0
    for at in sorted(p for word in _BEGINNINGS for p in _places(folded, word)):
        found = _ASSIGN.match(data, at) if at >= last else None
        if found:
            last = found.end()
            if last - found.start(2) >= 8:
                spans.append((at, last, 0))
                values.append(found.span(2))
    for found in _ACCESS.finditer(data) if b"AKIA" in data else ():
        if found.end() - found.start() >= 16:
            spans.append((*found.span(), 1))
            values.append(found.span())
    for start, end in _hex_runs(codes).tolist():
        spans.append((start, end, 2))
        values.append((start, end))
    spans.sort(key=lambda s: (s[0], s[2]))
    return np.array(spans, dtype=np.int64).reshape(-1, 3), np.array(sorted(values), dtype=np.int64).reshape(-1, 2)


# Tokens and features -------------------------------------------------------------------------------------

_WORDS = 4096  # numbers for neighbouring words
_SIGNS = 1280  # shapes of words; each sign is a shape of its own after them
_SHAPES = _SIGNS + 256
_LENGTHS = np.array([2, 4, 8, 12, 16, 20, 32, 40, 64])
#: Features of a token, each with its own table of weights.
TABLES = {
    "shape": _SHAPES, "shape_before": _SHAPES, "shape_after": _SHAPES, "touches": 4,
    "word_1": _WORDS, "word_2": _WORDS, "word_3": _WORDS, "word_after": _WORDS, "file": 64,
}
_STARTS = np.cumsum([0, *TABLES.values()])[:-1]
WIDTH = int(sum(TABLES.values()))

_codes = np.arange(256)
_digit = (_codes >= 48) & (_codes <= 57)
_upper, _lower = (_codes >= 65) & (_codes <= 90), (_codes >= 97) & (_codes <= 122)
_wide = _codes >= 128
_word = _digit | _upper | _lower | _wide | (_codes == 95)
#: 0 blank, 1 part of a word, 2 a sign.
_CLASS = np.where(_word, 1, np.where((_codes > 32) & (_codes != 127), 2, 0)).astype(np.int8)
_SORT = (_digit + 2 * _upper + 3 * _lower + 4 * _wide).astype(np.int8)
_FOLD = np.where(_upper, _codes + 32, _codes).astype(np.uint8)


def _fields(*flags) -> np.ndarray:
    """Flags of a byte as 21-bit fields of one word, so that one running sum counts them all."""
    return sum(f.astype(np.uint64) << np.uint64(21 * k) for k, f in enumerate(flags))


_COUNT_1 = _fields(_digit, _upper, _lower)
_COUNT_2 = _fields((_codes >= 97) & (_codes <= 102), _wide)
_FIELD = np.uint64((1 << 21) - 1)


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, a zero byte after each, and where each text begins."""
    data, edges = text_bytes(column)
    n = len(edges) - 1
    out = np.zeros(len(data) + n, dtype=np.uint8)
    lengths = np.diff(edges)
    out[np.arange(len(data)) + np.repeat(np.arange(n), lengths)] = data
    return out, edges[:-1] + np.arange(n)


class Tokens:
    """Tokens of joined texts: ``start``, ``end``, ``text`` (its number) and a feature row each."""

    def __init__(self, data: np.ndarray, firsts: np.ndarray):
        kind = _CLASS[data]
        before, after = np.concatenate(([0], kind[:-1])), np.concatenate((kind[1:], [0]))
        self.start = np.flatnonzero((kind == 2) | ((kind == 1) & (before != 1)))
        self.end = np.flatnonzero((kind == 2) | ((kind == 1) & (after != 1))) + 1
        self.text = np.searchsorted(firsts, self.start, side="right") - 1
        self.texts = len(firsts)
        self.shape = self._shapes(data)
        self.word = self._words(data)

    def _counts(self, table: np.ndarray, data: np.ndarray, fields: int) -> list[np.ndarray]:
        running = np.zeros(len(data) + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(table[data], out=running[1:])
            sums = running[self.end] - running[self.start]
        return [((sums >> np.uint64(21 * k)) & _FIELD).astype(np.int64) for k in range(fields)]

    def _shapes(self, data: np.ndarray) -> np.ndarray:
        length = self.end - self.start
        digit, upper, lower = self._counts(_COUNT_1, data, 3)
        letters, wide = self._counts(_COUNT_2, data, 2)
        sort = _SORT[data]
        turns = np.zeros(len(data) + 1, dtype=np.int64)
        turns[2:] = np.cumsum(sort[1:] != sort[:-1])
        switches = turns[self.end] - turns[np.minimum(self.start + 1, len(data))]
        of = np.searchsorted(_LENGTHS, length, side="right") * 16
        of += (digit > 0) + 2 * (upper > 0) + 4 * (lower > 0) + 8 * (wide > 0)
        of = (of * 2 + (digit + letters == length)) * 4 + np.searchsorted([1, 3, 6], switches, side="right")
        first = data[self.start] if len(data) else np.zeros(0, dtype=np.uint8)
        sign = _CLASS[first] == 2
        self.totals = digit, length, sign
        return np.where(sign, _SIGNS + first.astype(np.int64), of)

    def _words(self, data: np.ndarray) -> np.ndarray:
        """A number from 1 for the first eight bytes (A-Z lower-cased) and the length."""
        padded = np.concatenate((_FOLD[data], np.zeros(8, dtype=np.uint8)))
        length = self.end - self.start
        head = np.lib.stride_tricks.sliding_window_view(padded, 8)[self.start]
        head = np.where(np.arange(8) < length[:, None], head, 0).astype(np.uint8)
        key = np.ascontiguousarray(head).view("<u8").ravel() ^ (length.astype(np.uint64) << np.uint64(56))
        return 1 + (mix64(key) % np.uint64(_WORDS - 1)).astype(np.int64)

    def _files(self) -> np.ndarray:
        """Make-up of each text: shares of digits and signs, and its length."""
        digit, length, sign = self.totals
        total = np.maximum(1, np.bincount(self.text, length, self.texts))
        digits = np.searchsorted([0.01, 0.05, 0.2], np.bincount(self.text, digit, self.texts) / total, side="right")
        signs = np.searchsorted([0.02, 0.05, 0.15], np.bincount(self.text, sign, self.texts) / total, side="right")
        return (digits * 4 + signs) * 4 + np.searchsorted([200, 1000, 5000], total, side="right")

    def features(self) -> np.ndarray:
        """A column for each token: rows of the weight table, one for each feature."""

        def beside(values: np.ndarray, step: int) -> np.ndarray:
            """The value ``step`` tokens before (after, if negative), 0 beyond the text."""
            out = np.zeros(len(values), dtype=np.int64)
            here, there = (slice(step, None), slice(None, -step)) if step > 0 else (slice(None, step), slice(-step, None))
            same = self.text[here] == self.text[there]
            out[here] = np.where(same, values[there], 0)
            return out

        touch = np.zeros(len(self.start) + 1, dtype=np.int64)
        touch[1:-1] = self.start[1:] == self.end[:-1]
        rows = [
            self.shape, beside(self.shape, 1), beside(self.shape, -1), touch[:-1] * 2 + touch[1:],
            *(beside(self.word, k) for k in (1, 2, 3, -1)), self._files()[self.text],
        ]
        return np.stack([r + s for r, s in zip(rows, _STARTS)]).astype(np.int32)

    def labels(self, values: np.ndarray) -> np.ndarray:
        """Begin and inside for the tokens that lie in one of the spans (start, end), in order."""
        out = np.zeros(len(self.start), dtype=np.int8)
        for start, end in values.tolist():
            first, last = np.searchsorted(self.start, start), np.searchsorted(self.end, end, side="right")
            if first < last and not out[first]:
                out[first:last] = _IN
                out[first] = _BEGIN
        return out


# The field ------------------------------------------------------------------------------------------------

#: Inside can't follow outside.
_FORBIDDEN = np.zeros((3, 3))
_FORBIDDEN[_OUT, _IN] = -1e4


class Field:
    """Weights (feature row, tag) and transitions (from, to). Outside stands before and after each text."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def scores(self, features: np.ndarray) -> np.ndarray:
        total = np.zeros((features.shape[1], 3))
        for row in features:
            total += self.weights[row]
        return total

    def _surely_outside(self, scores: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Tokens that the best path has outside, whatever the others are.

        Let a path tag token k as a secret. Tag it outside instead, and token k + 1 begin if it was
        inside. That is a valid path. It differs in three transitions, each by the widest difference of
        allowed ones at most, and in the scores of these two tokens. Where it gains in any case, k is outside.
        """
        allowed = self.moves[_FORBIDDEN == 0]
        gain = scores[:, _OUT] - scores[:, _BEGIN:].max(axis=1) - 3 * (allowed.max() - allowed.min())
        to_begin = np.zeros(len(scores))
        to_begin[:-1] = np.maximum(0, scores[1:, _IN] - scores[1:, _BEGIN])
        to_begin[last] = 0
        return gain > to_begin

    def tags(self, scores: np.ndarray, text: np.ndarray) -> np.ndarray:
        """The best path of each text (Viterbi)."""
        out = np.zeros(len(scores), dtype=np.int8)
        if not len(scores):
            return out
        last = np.append(text[1:] != text[:-1], True)
        open_ = ~self._surely_outside(scores, last)
        begins = open_ & np.concatenate(([True], ~open_[:-1] | last[:-1]))
        ends = open_ & np.concatenate((~open_[1:] | last[:-1], [True]))
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        by_length = np.argsort(starts - stops, kind="stable")
        starts, sizes = starts[by_length], (stops - starts)[by_length]
        at = 0
        while at < len(starts):  # longest runs first; a table of about a million cells at once
            many = max(1, (1 << 20) // int(sizes[at]))
            self._decode(scores, starts[at : at + many], sizes[at : at + many], out)
            at += many
        return out

    def _decode(self, scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, out: np.ndarray) -> None:
        moves = self.moves + _FORBIDDEN
        best = moves[_OUT] + scores[starts]
        back = np.zeros((int(sizes[0]), len(starts), 3), dtype=np.int8)
        for step in range(1, int(sizes[0])):
            n = int(np.searchsorted(-sizes, -step))  # runs that are longer than the steps so far
            ways = best[:n, :, None] + moves
            back[step, :n] = ways.argmax(axis=1)
            best[:n] = ways.max(axis=1) + scores[starts[:n] + step]
        tag = (best + moves[:, _OUT]).argmax(axis=1)
        for step in range(int(sizes[0]) - 1, -1, -1):
            n = int(np.searchsorted(-sizes, -step))
            out[starts[:n] + step] = tag[:n]
            tag[:n] = back[step, np.arange(n), tag[:n]]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def hide(features: np.ndarray) -> np.ndarray:
    """The windows with the words unknown in every other one, and the shapes in the rest."""
    out = features.copy()
    for k, (name, start) in enumerate(zip(TABLES, _STARTS)):
        if name.startswith("word"):
            out[k, ::2] = start
        elif name.startswith("shape"):
            out[k, 1::2] = start
    return out


def learn(features: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, decay: float = 1e-4) -> Field:
    """Fit a field to windows of one length: features (rows, windows, tokens), labels (windows, tokens).

    Gradients of the conditional likelihood by forward and backward sums, steps by Adam. Tokens with a
    negative label lie beyond the text; they are outside and have no features.
    """
    windows, size = labels.shape
    real = labels >= 0
    gold = np.where(real, labels, _OUT)
    weights, moves = np.zeros((WIDTH, 3)), np.zeros((3, 3))
    hit = np.zeros((windows, size, 3))
    np.put_along_axis(hit, gold[..., None], 1.0, axis=2)
    padded = np.zeros((windows, size + 2), dtype=np.int64)
    padded[:, 1:-1] = gold
    seen_moves = np.bincount((padded[:, :-1] * 3 + padded[:, 1:]).ravel(), minlength=9).reshape(3, 3)
    flat = features.reshape(len(features), -1)
    state = [np.zeros_like(a) for a in (weights, weights, moves, moves)]
    for turn in range(1, rounds + 1):
        scores = np.zeros((windows * size, 3))
        for row in flat:
            scores += weights[row]
        scores = scores.reshape(windows, size, 3) * real[..., None]
        scores[..., _BEGIN:] -= 1e4 * ~real[..., None]
        step = moves + _FORBIDDEN
        ahead, behind = np.empty_like(scores), np.empty_like(scores)
        ahead[:, 0] = step[_OUT] + scores[:, 0]
        for k in range(1, size):
            ahead[:, k] = _log_sum(ahead[:, k - 1, :, None] + step, 1) + scores[:, k]
        behind[:, -1] = step[:, _OUT]
        for k in range(size - 2, -1, -1):
            behind[:, k] = _log_sum(step + (scores[:, k + 1] + behind[:, k + 1])[:, None, :], 2)
        total = _log_sum(ahead[:, -1] + step[:, _OUT], 1)
        share = np.exp(ahead + behind - total[:, None, None])
        miss = ((hit - share) * real[..., None]).reshape(-1, 3)
        up = np.stack(
            [sum(np.bincount(row, miss[:, tag], WIDTH) for row in flat) for tag in range(3)], axis=1
        )
        between = np.exp(
            ahead[:, :-1, :, None] + step + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        ).sum(axis=(0, 1))
        between[_OUT] += share[:, 0].sum(axis=0)
        between[:, _OUT] += share[:, -1].sum(axis=0)
        up_moves = np.where(_FORBIDDEN == 0, seen_moves - between, 0)
        for value, grad, m, v in ((weights, up, *state[:2]), (moves, up_moves, *state[2:])):
            grad = grad / windows - decay * value
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value += 0.15 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return Field(weights, moves)


# Spark ------------------------------------------------------------------------------------------------------


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of tokens around secrets, around a token with digits, and around any token of each text."""
    size = 2 * BESIDE + 1
    for part in slices(batches, "text", SLICE_BYTES):
        data, firsts = joined(part.column(1))
        tokens = Tokens(data, firsts)
        if not len(tokens.start):
            continue
        labels = tokens.labels(pattern_spans(data)[1])
        features = tokens.features()
        n = len(labels)
        lot = mix64(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + tokens.start.astype(np.uint64))
        any_token, digits = np.zeros(n, dtype=bool), (tokens.totals[0] > 0) & (labels == _OUT)
        for chosen in (np.ones(n, dtype=bool), digits):
            some = np.flatnonzero(chosen)
            some = some[np.lexsort((lot[some], tokens.text[some]))]
            any_token[some[np.concatenate(([True], np.diff(tokens.text[some]) > 0))[: len(some)]]] = True
        for secret, centres in ((True, np.flatnonzero(labels == _BEGIN)), (False, np.flatnonzero(any_token))):
            if not len(centres):
                continue
            at = centres[:, None] + np.arange(-BESIDE, BESIDE + 1)
            inside = (at >= 0) & (at < n)
            at = np.clip(at, 0, n - 1)
            inside &= tokens.text[at] == tokens.text[centres][:, None]
            tags = np.where(inside, labels[at], -1).astype(np.int8)
            # inside without its begin can't be told from a secret's begin here
            broken = (tags[:, 0] == _IN) | ((tags[:, 1:] == _IN) & (tags[:, :-1] <= _OUT)).any(axis=1)
            rows = np.ascontiguousarray(features[:, at].transpose(1, 0, 2))
            kept = np.flatnonzero(~broken)
            # windows of one text have its key and their own lot
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([secret] * len(kept)),
                    part.column(0).take(pa.array(tokens.text[centres[kept]])),
                    pa.array((centres[kept] * size).astype(np.int64)),
                    pa.array([rows[k].tobytes() for k in kept], type=pa.binary()),
                    pa.array([tags[k].tobytes() for k in kept], type=pa.binary()),
                ],
                names=["secret", "key", "at", "features", "tags"],
            )


def fit(docs: DataFrame, most_texts: int = SAMPLE, most_windows: int = WINDOWS) -> Field | None:
    """A field learnt from the texts with the smallest hashes, ``most_texts`` different ones at most.

    Half of ``most_windows`` may hold secrets that the patterns find, the other half is around other tokens.
    Only these windows reach the driver, some 1.3 KB each. None if there is no secret among them.
    """
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    smallest = keyed.select("key").distinct().orderBy("key").limit(most_texts)
    edge = smallest.agg(F.max("key")).first()[0]
    if edge is None:
        return None
    found = (
        keyed.filter(F.col("key") <= edge)
        .select("key", "text")
        .dropDuplicates(["key"])
        .mapInArrow(_windows, "secret boolean, key bigint, at bigint, features binary, tags binary")
    )
    order = [F.xxhash64("key", "features"), F.col("key"), F.col("features")]
    picked = [
        found.filter(F.col("secret") == secret).orderBy(*order).limit(most_windows // 2).collect()
        for secret in (True, False)
    ]
    if not picked[0]:
        return None
    rows = picked[0] + picked[1]
    size = 2 * BESIDE + 1
    features = np.stack([np.frombuffer(r["features"], dtype=np.int32) for r in rows])
    labels = np.stack([np.frombuffer(r["tags"], dtype=np.int8) for r in rows]).astype(np.int64)
    shaped = np.ascontiguousarray(features.reshape(len(rows), len(TABLES), size).transpose(1, 0, 2))
    return learn(np.concatenate([shaped, hide(shaped)], axis=1), np.concatenate([labels, labels]))


def tagged_spans(data: np.ndarray, firsts: np.ndarray, field: Field, known: np.ndarray) -> np.ndarray:
    """(start, end) of tagged secrets that are long enough and share no byte with ``known`` spans."""
    tokens = Tokens(data, firsts)
    tags = field.tags(field.scores(tokens.features()), tokens.text) if len(tokens.start) else np.zeros(0, np.int8)
    begins = np.flatnonzero(tags == _BEGIN)
    if not len(begins):
        return np.zeros((0, 2), dtype=np.int64)
    stops = np.flatnonzero(np.append(tags, _OUT) != _IN)
    lasts = stops[np.searchsorted(stops, begins, side="right")] - 1
    spans = np.stack([tokens.start[begins], tokens.end[lasts]], axis=1)
    taken = np.zeros(len(data) + 1, dtype=np.int64)
    for start, end, _ in known.tolist():
        taken[start:end] = 1
    taken = np.concatenate(([0], np.cumsum(taken)))
    free = taken[spans[:, 1]] == taken[spans[:, 0]]
    return spans[free & (spans[:, 1] - spans[:, 0] >= LEAST)]


def _scan(field: Field | None) -> Callable:
    def spelled(rows: np.ndarray) -> str:
        return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in rows.tolist())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for part in slices(batches, "text", SLICE_BYTES):
            data, firsts = joined(part.column(1))
            base, _ = pattern_spans(data)
            more = tagged_spans(data, firsts, field, base) if field else np.zeros((0, 2), dtype=np.int64)
            more = np.column_stack([more, np.full(len(more), 3)])
            spans = np.concatenate([base, more])
            spans = spans[np.lexsort((spans[:, 2], spans[:, 0]))]
            of = np.searchsorted(firsts, spans[:, 0], side="right") - 1
            # bytes that begin a character, counted from the text's first
            points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            spans[:, :2] = points[spans[:, :2]] - points[firsts[of]][:, None]
            n = part.num_rows
            counts = [np.bincount(of[spans[:, 2] == kind], minlength=n) for kind in range(3)]
            digest, everything = [nothing] * n, [""] * n
            cuts = np.flatnonzero(np.concatenate(([True], np.diff(of) > 0)))[: len(of)]
            for a, b in zip(cuts, np.append(cuts[1:], len(of))):
                rows = spans[a:b]
                everything[of[a]] = spelled(rows)
                digest[of[a]] = hashlib.sha256(spelled(rows[rows[:, 2] < 3]).encode()).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c.astype(np.int64)) for c in counts), pa.array(digest), pa.array(everything)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return scan


def scan_documents(docs: DataFrame, most_texts: int = SAMPLE, most_windows: int = WINDOWS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row: patterns and the field's finds."""
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    field = fit(docs, most_texts, most_windows)
    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return docs.mapInArrow(_scan(field), schema)
