"""Interpolated modified Kneser-Ney bigram model, counted in Spark, held in sorted hash arrays.

Counting never moves single tokens. Tasks sort and add up what they read, cut the result by hash into
buckets, and other tasks merge one bucket each and write it as a sorted array to the shared folder (under
its final name in one step, so that a repeated task replaces its own work). Words are cut by their
hash, pairs by the hash of the pair, so a very common word or context is spread over all buckets.
Scoring tasks map the arrays into memory and look up sorted distinct words and pairs of a few million
tokens at a time. Statistics of words go by ranges of neighbouring word buckets, sized by what the pair buckets
can send for their words (a word sends one entry for each pair bucket at most). The driver sees totals and
one row per bucket or range. Words are numbered in 32 bits; a vocabulary beyond that raises an error.

P(v|u) = max(c(uv) - D(c), 0) / c(u) + g(u) P(v), where P(v) rests on the number of different contexts
of v, discounted likewise and interpolated with 1 / (V + 1); discounts come from the counts of counts.

Cases: a null or empty text is its end token alone; repeated rows count each; a null doc_id is learned
from; without learning rows all probabilities are 1; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import collapse_sorted, documents, mix64, settle, ship_code, word_hashes
from cardlake.sources.shared import fresh_path

CHUNK = 1_000_000  # tokens handled together in a task
BUCKET = 4_000_000  # tokens per bucket of words or pairs
RANGE = 2_000_000  # statistics of words that one task adds up, as far as pair buckets can send them
END = np.uint64(0x0E0D0C0B0A090807)
_M1 = np.uint64(pow(0xFF51AFD7ED558CCD, -1, 1 << 64))
_M2 = np.uint64(pow(0xC4CEB9FE1A85EC53, -1, 1 << 64))


def unmix64(x: np.ndarray) -> np.ndarray:
    """The reverse of ``mix64``."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * _M2
        x = (x ^ (x >> np.uint64(33))) * _M1
        return x ^ (x >> np.uint64(33))


def _squeeze(values: np.ndarray, rising: bool = False) -> bytes:
    """Compressed integers; ``rising`` ones as differences. Equal bytes of all values lie together."""
    kind = values.dtype
    if rising:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = values.view(np.uint8).reshape(-1, kind.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _expand(data: bytes, kind: str, rising: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    values = np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if rising else values


class Store:
    """Arrays in a folder all workers see; a folder that is no mounted path is read through a copy."""

    def __init__(self, folder: str):
        self.folder = folder
        self._maps: dict[str, np.ndarray] = {}
        self._copies = None

    def __getstate__(self):
        return {"folder": self.folder, "_maps": {}, "_copies": None}

    def _mounted(self) -> str | None:
        parts = urlparse(self.folder)
        return parts.path if parts.scheme in ("", "file") else None

    def save(self, name: str, values: np.ndarray) -> None:
        path, trial = self._mounted(), f".{name}-{uuid.uuid4().hex}"
        if path:
            os.makedirs(path, exist_ok=True)
            with open(f"{path}/{trial}", "wb") as target:
                np.save(target, values)
            os.replace(f"{path}/{trial}", f"{path}/{name}")
            return
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.folder)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{trial}") as target:
            np.save(target, values)
        system.move(f"{path}/{trial}", f"{path}/{name}")

    def load(self, name: str) -> np.ndarray:
        if name not in self._maps:
            path = self._mounted()
            if path:
                local = f"{path}/{name}"
            else:
                from pyarrow import fs

                self._copies = self._copies or tempfile.TemporaryDirectory(prefix="lm-")
                local = f"{self._copies.name}/{name}"
                system, path = fs.FileSystem.from_uri(self.folder)
                with system.open_input_stream(f"{path}/{name}") as source, open(local, "wb") as target:
                    shutil.copyfileobj(source, target)
            self._maps[name] = np.load(local, mmap_mode="r")
        return self._maps[name]


def _chunks(batches, columns):
    """(rows, hashes of their tokens, tokens of each) for a bounded number of tokens at a time."""
    rows, hashes, total = [], [], 0
    for batch in batches:
        for row in zip(*(batch[c] for c in columns)):
            found = np.append(word_hashes(row[-1], lower=True), END)
            rows.append(row[:-1])
            hashes.append(found)
            total += len(found)
            if total >= CHUNK:
                yield rows, np.concatenate(hashes), np.array([len(h) for h in hashes])
                rows, hashes, total = [], [], 0
    if rows:
        yield rows, np.concatenate(hashes), np.array([len(h) for h in hashes])


def _smallest(counts: np.ndarray) -> np.ndarray:
    """Counts in 32 bits, or in 64 where one of them needs them."""
    return counts.astype(np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.uint64)


def range_edges(offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Word numbers at which ranges of whole buckets begin, and the end: each has at most RANGE or is one bucket."""
    edges, held = [0], 0
    for b, weight in enumerate(weights.tolist()):
        if held and held + weight > RANGE:
            edges.append(int(offsets[b]))
            held = 0
        held += weight
    return np.array([*edges, int(offsets[-1])], dtype=np.int64)


def _distinct(values: np.ndarray):
    """Sorted distinct values, and for each value its place among them."""
    order = np.argsort(values)
    ranked = values[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, bool)
    place = np.empty(len(values), dtype=np.int64)
    place[order] = np.cumsum(first) - 1
    return ranked[first], place


def _by_bucket(ranked: np.ndarray, bits: int):
    """(bucket, begin, end) of sorted hashes."""
    of = (ranked >> np.uint64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, int)
    return zip(of[cut].tolist(), cut.tolist(), np.append(cut[1:], len(of)).tolist())


def _find(store: Store, prefix: str, ranked: np.ndarray, bits: int, have: set[int]):
    """For sorted distinct hashes: the bucket and the place in it, or -1."""
    bucket = np.zeros(len(ranked), dtype=np.int64)
    place = np.full(len(ranked), -1, dtype=np.int64)
    for b, begin, end in _by_bucket(ranked, bits):
        bucket[begin:end] = b
        if b not in have:
            continue
        table = store.load(f"{prefix}{b}")
        at = np.minimum(np.searchsorted(table, ranked[begin:end]), len(table) - 1)
        place[begin:end] = np.where(table[at] == ranked[begin:end], at, -1)
    return bucket, place


def _discounts(n: list[int]) -> np.ndarray:
    """What is taken from counts 0, 1, 2 and 3 or more, by the numbers of counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    d1 = 1 - 2 * y * n2 / n1 if n1 and n2 else 0.5
    d2 = 2 - 3 * y * n3 / n2 if n2 and n3 else 1.0
    d3 = 3 - 4 * y * n4 / n3 if n3 and n4 else 1.5
    return np.array([0.0, min(max(d1, 0.05), 1), min(max(d2, 0.05), 2), min(max(d3, 0.05), 3)])


class Model:
    """Where the arrays of a fitted model lie, and its totals."""

    def __init__(self, folder: str, bits: int):
        self.store, self.bits = Store(folder), bits
        self.words, self.pairs = set(), set()  # buckets that exist
        self.offsets = np.zeros((1 << bits) + 1, dtype=np.int64)
        self.edges = np.zeros(2, dtype=np.int64)  # of the ranges of words
        self.tokens = self.vocabulary = self.texts = self.kinds = 0
        self.pair_cut = self.word_cut = np.zeros(4)
        self.start_rest = self.word_rest = 0.0

    def ids(self, ranked: np.ndarray):
        """Word numbers of sorted distinct hashes (-1: unknown), with bucket and place."""
        bucket, place = _find(self.store, "words", ranked, self.bits, self.words)
        return np.where(place >= 0, self.offsets[bucket] + place, -1), bucket, place

    def _gather(self, prefix: str, bucket, place, row=None) -> np.ndarray:
        out = np.zeros(len(place), dtype=np.float64)
        known = place >= 0
        for b in np.unique(bucket[known]).tolist():
            mine = known & (bucket == b)
            table = self.store.load(f"{prefix}{b}")
            out[mine] = (table if row is None else table[row])[place[mine]]
        return out

    def score(self, hashes: np.ndarray, lengths: np.ndarray):
        """Per text: known tokens, base score, model score (log10)."""
        ranked, which = _distinct(hashes)
        number, bucket, place = self.ids(ranked)
        count = self._gather("counts", bucket, place)
        span = np.searchsorted(self.edges[1:-1], number, side="right")
        inside = np.where(number >= 0, number - self.edges[span], -1)
        kinds, *n = (self._gather("stats", span, inside, r) for r in range(4))
        word = np.full(len(ranked), 1.0 / (self.vocabulary + 1))
        rest = np.zeros(len(ranked))
        if self.kinds:
            cut = self.word_cut[np.minimum(kinds, 3).astype(int)]
            word = np.maximum(kinds - cut, 0) / self.kinds + self.word_rest / (self.vocabulary + 1)
            rest = sum(self.pair_cut[i + 1] * n[i] for i in range(3)) / np.maximum(count, 1)
        starts = np.cumsum(lengths) - lengths
        first = np.zeros(len(hashes), dtype=bool)
        first[starts] = True
        before = np.concatenate(([0], which[:-1])) if len(which) else which
        u = np.where(first, self.vocabulary, number[before])
        v = number[which]
        total = np.where(first, float(self.texts), count[before])
        share = np.where(first, self.start_rest, rest[before])
        known = (u >= 0) & (v >= 0) & (total > 0)
        seen = np.zeros(len(hashes))
        keys = mix64((u[known].astype(np.uint64) << np.uint64(32)) | v[known].astype(np.uint64))
        pairs, at = _distinct(keys)
        seen[known] = self._gather("paircounts", *_find(self.store, "pairs", pairs, self.bits, self.pairs))[at]
        cut = self.pair_cut[np.minimum(seen, 3).astype(int)]
        own = word[which]
        p = np.where(total > 0, np.maximum(seen - cut, 0) / np.maximum(total, 1) + share * own, own)
        c = count[which]
        base = np.log10((c + 0.1) / (self.tokens + 0.1 * (self.vocabulary + 1)))
        add = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
        return add((c > 0).astype(np.int64)), add(base), add(np.log10(np.maximum(p, 1e-300)))


def _merge(group: pd.DataFrame, kind: str):
    keys = np.concatenate([_expand(k, "uint64", True) for k in group["keys"]])
    counts = np.concatenate([_expand(c, kind) for c in group["counts"]])
    return collapse_sorted(keys, counts.astype(np.int64))


def fit(texts: DataFrame) -> Model:
    """Count a table with a column ``text``."""
    spark = texts.sparkSession
    ship_code(spark)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(1, min(20, (size // (6 * BUCKET)).bit_length()))
    model = Model(fresh_path(spark, "lm"), bits)
    store = model.store

    def count_words(batches):
        for _, hashes, _ in _chunks(batches, ["text"]):
            ranked, counts = collapse_sorted(hashes)
            counts = counts.astype(np.uint32)
            yield pd.DataFrame(
                [(b, _squeeze(ranked[x:y], True), _squeeze(counts[x:y])) for b, x, y in _by_bucket(ranked, bits)],
                columns=["bucket", "keys", "counts"],
            )

    def keep_words(group):
        ranked, counts = _merge(group, "uint32")
        b = int(group["bucket"].iloc[0])
        store.save(f"words{b}", ranked)
        store.save(f"counts{b}", counts)
        weight = int(np.minimum(counts, 1 << bits).sum())
        return pd.DataFrame({"bucket": [b], "n": [len(ranked)], "total": [int(counts.sum())], "weight": [weight]})

    part = "bucket int, keys binary, counts binary"
    words = settle(
        texts.select("text").mapInPandas(count_words, part).groupBy("bucket").applyInPandas(
            keep_words, "bucket int, n bigint, total bigint, weight bigint"
        ), "lm_words",
    ).collect()
    sizes, weights = np.zeros((2, 1 << bits), dtype=np.int64)
    for r in words:
        sizes[r["bucket"]], weights[r["bucket"]] = r["n"], r["weight"]
        model.tokens += r["total"]
    model.words = {r["bucket"] for r in words}
    model.offsets = np.concatenate(([0], np.cumsum(sizes)))
    model.vocabulary = int(model.offsets[-1])
    if model.vocabulary + 1 >= 1 << 32:
        raise ValueError(f"{model.vocabulary} different words do not fit 32-bit numbers")
    model.edges = range_edges(model.offsets, weights)
    model.texts = texts.count()
    if not model.vocabulary:
        return model

    def count_pairs(batches):
        for _, hashes, lengths in _chunks(batches, ["text"]):
            ranked, which = _distinct(hashes)
            v = model.ids(ranked)[0][which].astype(np.uint64)
            u = np.concatenate((v[:1], v[:-1]))
            u[np.cumsum(lengths) - lengths] = np.uint64(model.vocabulary)
            keys, counts = collapse_sorted(mix64((u << np.uint64(32)) | v))
            counts = counts.astype(np.uint32)
            yield pd.DataFrame(
                [(b, _squeeze(keys[x:y], True), _squeeze(counts[x:y])) for b, x, y in _by_bucket(keys, bits)],
                columns=["bucket", "keys", "counts"],
            )

    edges = np.append(model.edges, model.vocabulary + 1)  # the start of a text has a range of its own

    def keep_pairs(group):
        keys, counts = _merge(group, "uint32")
        b = int(group["bucket"].iloc[0])
        store.save(f"pairs{b}", keys)
        store.save(f"paircounts{b}", _smallest(counts))
        pair = unmix64(keys)
        v, kinds = collapse_sorted(pair & np.uint64(0xFFFFFFFF))
        order = np.argsort(pair >> np.uint64(32))
        ordered, c = (pair >> np.uint64(32))[order], np.minimum(counts[order], 3)
        u = collapse_sorted(ordered)[0]
        at = np.searchsorted(ordered, u)
        n = [np.add.reduceat((c == i).astype(np.int64), at) for i in (1, 2, 3)]
        rows = [(-1, b, [], [int((counts == i).sum()) for i in (1, 2, 3, 4)])]
        vs, us = np.searchsorted(v, edges), np.searchsorted(u, edges)
        for w in range(len(edges) - 1):
            x, y, s, t = vs[w], vs[w + 1], us[w], us[w + 1]
            if x == y and s == t:
                continue
            parts = [
                _squeeze((v[x:y] - np.uint64(edges[w])).astype(np.uint32), True), _squeeze(kinds[x:y].astype(np.uint32)),
                _squeeze((u[s:t] - np.uint64(edges[w])).astype(np.uint32), True),
                *(_squeeze(k[s:t].astype(np.uint32)) for k in n),
            ]
            rows.append((w, b, parts, []))
        return pd.DataFrame(rows, columns=["span", "bucket", "parts", "numbers"])

    pairs = settle(
        texts.select("text").mapInPandas(count_pairs, part).groupBy("bucket").applyInPandas(
            keep_pairs, "span int, bucket int, parts array<binary>, numbers array<bigint>"
        ), "lm_pairs",
    )
    totals = pairs.filter("span = -1").collect()
    model.pairs = {r["bucket"] for r in totals}
    model.pair_cut = _discounts(np.sum([r["numbers"] for r in totals], axis=0).tolist())
    lengths = np.diff(edges)

    def keep_stats(group):
        w = int(group["span"].iloc[0])
        table = np.zeros((4, lengths[w]), dtype=np.uint32)
        for parts in group["parts"]:
            v, u = _expand(parts[0], "uint32", True), _expand(parts[2], "uint32", True)
            table[0, v] += _expand(parts[1], "uint32")
            for i in (1, 2, 3):
                table[i, u] += _expand(parts[i + 2], "uint32")
        store.save(f"stats{w}", table)
        kinds = [int((table[0] == i).sum()) for i in (1, 2, 3, 4)]
        numbers = [*kinds, int((table[0] > 2).sum()), int(table[0].sum()), *table[1:, 0].tolist()]
        return pd.DataFrame({"span": [w], "numbers": [numbers]})

    stats = settle(
        pairs.filter("span >= 0").groupBy("span").applyInPandas(
            keep_stats, "span int, numbers array<bigint>"
        ), "lm_stats",
    ).collect()
    last = len(lengths) - 1
    start = next(r["numbers"] for r in stats if r["span"] == last)
    model.start_rest = float(model.pair_cut[1:] @ np.array(start[6:9], dtype=float)) / model.texts
    sums = np.sum([r["numbers"][:6] for r in stats if r["span"] < last], axis=0)
    model.kinds = int(sums[5])
    model.word_cut = _discounts(sums[:4].tolist())
    model.word_rest = float(model.word_cut[1:] @ np.array([sums[0], sums[1], sums[4]], dtype=float)) / model.kinds
    return model


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))


def score_texts(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""

    def scores(batches):
        for ids, hashes, lengths in _chunks(batches, ["doc_id", "held_out", "text"]):
            known, base, score = model.score(hashes, lengths)
            yield pd.DataFrame(
                {
                    "doc_id": pd.array([None if pd.isna(i) else i for i, _ in ids], dtype="Int64"),
                    "held_out": [h for _, h in ids],
                    "n_tokens": lengths, "n_known": known, "train_tokens": model.tokens,
                    "base_score": base, "score": score, "perplexity": 10 ** np.minimum(300, -score / lengths),
                }
            )

    return rows.select("doc_id", "held_out", "text").mapInPandas(
        scores,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double, perplexity double",
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out and score all."""
    rows = documents(docs).withColumn("held_out", held_out())
    return score_texts(rows, fit(rows.filter(~F.col("held_out"))))
