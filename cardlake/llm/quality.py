"""Quality scores: ridge regression on random Fourier features, calibrated by isotonic regression.

A text becomes a row of statistics (lengths, repetition, punctuation, letter kinds). Random cosine
features of the standardised statistics approximate a Gaussian kernel. Each partition adds up its
part of the normal equations; the sums are a matrix of fixed size, solved on the driver. Raw scores of
the learning rows fall into a fixed grid; pooling adjacent violators on the grid's counts makes them
probabilities.

Learning uses about ``most_rows`` labelled rows at most (where there are more, the share by a hash of doc_id
that is expected to give as many);
every text is scored. Cases: a null text is empty; labels that are null count as absent, several
labels of one document count as their mean; without labels every score is 0.5, with one kind of
label it is that label; repeated rows are scored each; a null doc_id is never learned from; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import documents, settle

FEATURES = 256
WIDTH = 5.0  # of the Gaussian kernel, in standard deviations of a statistic
RIDGE = 1e-3  # per learning row
MOST_ROWS = 200_000
GRID = 2_048
THRESHOLD = 0.3

_KINDS = np.zeros((256, 7))
for _b in range(256):
    _c = chr(_b)
    _KINDS[_b] = [
        _b < 128 and _c.isupper(), _b < 128 and _c.islower(), 48 <= _b < 58, _b in (32, 9, 13),
        _b in b".,;:!?", _b < 128 and _c.isprintable() and not _c.isalnum() and _b not in b" .,;:!?", _b >= 128,
    ]
N_STATS = 26


def statistics(text: str | None) -> np.ndarray:
    """What is measured of a text; finite for any text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    kinds = counts @ _KINDS / max(1, len(raw))
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    tally = Counter(words)
    top = max(tally.values(), default=0)
    distinct_lines = len(set(lines))
    line_count = max(1, len(lines))
    ends = sum(x.rstrip()[-1] in ".!?" for x in lines)
    expected = n**0.8
    return np.array(
        [
            np.log1p(len(raw)), np.log1p(len(words)), lengths.mean(), lengths.std(),
            np.log1p(lengths.max()), len(tally) / n, len(tally) / expected, top / n,
            sum(map(eq, words, words[1:])) / n, sum(v for v in tally.values() if v > 1) / n,
            (lengths <= 1).mean(), (lengths <= 3).mean(), (lengths >= 12).mean(), (lengths >= 20).mean(),
            *kinds, np.log1p(line_count), distinct_lines / line_count, np.log1p(n / line_count),
            ends / line_count, counts[10] / max(1, len(raw)),
        ]
    )


def statistics_of(text: str | Column) -> Column:
    """The statistics as a column."""

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return measured(text)


@dataclass
class Model:
    """A fitted scorer; a few hundred kilobytes whatever it was fitted on."""

    centre: np.ndarray
    spread: np.ndarray
    turns: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    heights: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.centre) / self.spread, -6, 6)
        z = np.cos(x @ self.turns + self.shifts) * np.sqrt(2 / len(self.shifts))
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.heights)


def _rows(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype(np.float64) if len(series) else np.zeros((0, N_STATS))


def pool_violators(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The nondecreasing sequence nearest to ``value`` in weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def _constant(height: float) -> Model:
    return Model(
        np.zeros(N_STATS), np.ones(N_STATS), np.zeros((N_STATS, 1)), np.zeros(1), np.zeros(2),
        np.array([0.0, 1.0]), np.array([height, height]),
    )


def fit(stats: DataFrame, labels: DataFrame, learn: Column, most_rows: int = MOST_ROWS, seed: int = 7) -> Model:
    """Fit on the rows of ``stats`` (doc_id, stats) for which ``learn`` holds and that have a label."""
    marks = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("_y"))
        .filter("_y IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.avg("_y").alias("_y"))
        .filter(learn)
    )
    known = marks.count()
    if known > most_rows:
        part = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
        marks = marks.filter(part < most_rows / known)
    rows = settle(stats.join(marks, "doc_id"), "learning_rows")
    sums = rows.agg(F.count("*"), F.avg("_y"), F.min("_y"), F.max("_y")).first()
    if not sums[0]:
        return _constant(0.5)
    if sums[2] == sums[3]:
        return _constant(float(sums[1]))
    moments = rows.agg(
        *(F.avg(F.col("stats")[i]) for i in range(N_STATS)),
        *(F.stddev_pop(F.col("stats")[i]) for i in range(N_STATS)),
    ).first()
    spread = np.array(moments[N_STATS:], dtype=float)
    random = np.random.default_rng(seed)
    model = Model(
        np.array(moments[:N_STATS], dtype=float), np.where(spread > 1e-9, spread, 1.0),
        random.normal(size=(N_STATS, FEATURES)) / WIDTH, random.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([0.0, 1.0]),
    )

    def equations(batches):
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = model.features(_rows(batch["stats"]))
            total += np.hstack([z.T @ z, (z.T @ batch["_y"].to_numpy())[:, None]])
        yield pd.DataFrame({"row": range(FEATURES + 1), "sums": [r.tobytes() for r in total]})

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b) for b in parts["sums"]], axis=0)
        return pd.DataFrame({"row": parts["row"].iloc[:1], "sums": [total.tobytes()]})

    summed = (
        rows.mapInPandas(equations, "row int, sums binary")
        .groupBy("row")
        .applyInPandas(add, "row int, sums binary")
        .collect()
    )  # one row per feature
    system = np.stack([np.frombuffer(r["sums"]) for r in sorted(summed, key=lambda r: r["row"])])
    gram, right = system[:, :-1], system[:, -1]
    model.weights = np.linalg.solve(gram + RIDGE * sums[0] / FEATURES * np.eye(len(gram)), right)

    def to_grid(batches):
        for batch in batches:
            cell = np.clip((model.raw(_rows(batch["stats"])) + 1) / 3 * GRID, 0, GRID - 1).astype(np.int32)
            yield pd.DataFrame({"cell": cell, "y": batch["_y"].to_numpy()})

    cells = (
        rows.mapInPandas(to_grid, "cell int, y double")
        .groupBy("cell")
        .agg(F.sum("y").alias("y"), F.count("*").alias("n"))
        .toPandas()
        .sort_values("cell")
    )  # at most GRID rows
    n = cells["n"].to_numpy(dtype=float)
    level = pool_violators(cells["y"].to_numpy() / n, n)
    model.knots = (cells["cell"].to_numpy() + 0.5) * 3 / GRID - 1
    # a slight slope keeps the order of scores inside a pooled block
    model.heights = np.clip(0.999 * level + 0.001 * (model.knots + 1) / 3, 0, 1)
    return model


def scorer(model: Model):
    """A column function: statistics to score."""

    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        return pd.Series(model.score(_rows(stats)))

    return score


def learns() -> Column:
    """Rows outside the held-out fifth."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0


def document_statistics(docs: DataFrame) -> DataFrame:
    return documents(docs).select("doc_id", statistics_of("text").alias("stats"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    stats = settle(document_statistics(docs), "document_statistics")
    score = scorer(fit(stats, labels, learns()))
    return stats.select(
        "doc_id", F.coalesce(~learns(), F.lit(False)).alias("held_out"), score("stats").alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    model = fit(document_statistics(docs), labels, learns())
    text = F.coalesce("text", F.lit(""))
    return docs.filter(scorer(model)(statistics_of(text)) >= threshold)
