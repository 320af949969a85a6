"""Near-duplicate documents by SetSketch registers, verified on full shingle sets.

A document's set holds its distinct five-word shingles. Documents with equal sets become one class
before anything else, so thousands of copies are one row. A register of the sketch is the smallest
of exponentially distributed hashes on a logarithmic scale (base 1.001), truncated to 16 bits;
registers of a union are the larger of both. Classes whose registers agree in a whole band meet in a
bucket; links to a bucket's smallest member gather buckets to clusters. In a cluster the likelihood of
the registers, given both set sizes, drops pairs that are clearly below the threshold; the others
are confirmed on the full sets, slice by slice of the members, most alike first in a slice, and skipped
once confirmed links connect them, so that only a slice's pairs are in memory.
Clusters beyond a size are dealt to tasks as pairs of blocks, so that any two members meet in a
bounded task; only confirmed links leave a task, fewer than it has members. A pair at the threshold
is missed by all bands with a probability below one in a million.

Cases: A-Z are folded, words are runs without blanks; a text of one to four words is one shingle; a
text without words (or null) is linked with nothing; repeated rows share a class; a null doc_id
takes part as the smallest id; rows that share a doc_id (or have none) with different texts are
different documents, the first of them the one whose text has the smallest hash; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.common import documents, mix64, null_id, real_id, settle, ship_code, word_hashes
from cardlake.llm.components import components

WORDS = 5
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2  # the scale of a register
BLOCK_BYTES = 16_000_000  # of shingles and sketches in one block of a cluster
BLOCK_MEMBERS = 4096
SLICE = 64  # members compared with the others at a time
DOUBT = 0.15  # pairs estimated this far below the threshold are dropped; over four deviations
_STEPS = mix64(np.arange(11, 11 + WORDS, dtype=np.uint64)) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = word_hashes(text, lower=True)
    n = len(words)
    if n == 0:
        return words
    with np.errstate(over="ignore"):
        if n < WORDS:
            return mix64((words * _STEPS[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
        total = words[: n - WORDS + 1] * _STEPS[0]
        for i in range(1, WORDS):
            total = total + words[i : n - WORDS + 1 + i] * _STEPS[i]
    found = np.sort(mix64(total))
    return found[np.concatenate(([True], found[1:] != found[:-1]))]


def _factors(registers: int) -> np.ndarray:
    return mix64(np.arange(1001, 1001 + registers, dtype=np.uint64)) | np.uint64(1)


def smallest_hashes(found: np.ndarray, registers: int) -> np.ndarray:
    """For each register the smallest hash of a set; the minimum of two sets' is their union's."""
    factors = _factors(registers)[:, None]
    least = np.full(registers, np.uint64((1 << 64) - 1))
    with np.errstate(over="ignore"):
        for at in range(0, len(found), 4096):
            np.minimum(least, (factors * found[None, at : at + 4096]).min(axis=1), out=least)
    return least


def to_registers(least: np.ndarray) -> np.ndarray:
    """Smallest hashes as exponential variables on the truncated logarithmic scale."""
    share = (least.astype(np.float64) + 1) / 2.0**64
    spread = -np.log1p(-np.minimum(share, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(spread) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def _slope(x: np.ndarray) -> np.ndarray:
    c = (BASE - 1) / BASE
    return c / ((1 - np.clip(x, 0, 1) * c) * np.log(BASE))


def at_least(above, below, same, size_a, size_b, likeness: float):
    """Whether the joint likelihood of registers is greatest at this Jaccard likeness or beyond.

    above, below, same: registers of a that are larger, smaller, equal. The log-likelihood is concave
    in the likeness, so the sign of its slope there decides.
    """
    u = size_a / (size_a + size_b)
    v = 1 - u
    most = np.minimum(u, v) / np.maximum(u, v)
    j = np.minimum(likeness, most * (1 - 1e-9))
    only_a, only_b = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
    pa, pb = np.maximum(_p(only_a), 1e-12), np.maximum(_p(only_b), 1e-12)
    da, db = -v * _slope(only_a), -u * _slope(only_b)
    rest = np.maximum(1 - pa - pb, 1e-12)
    return above * da / pa + below * db / pb - same * (da + db) / rest >= 0


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def _links(reps, sizes, sketches, sets, sides, percent):
    """Confirmed links that connect what is connected among the members.

    sides: None for all pairs, else 0 or 1 for each member; only pairs of both sides count then.
    """
    m = len(reps)
    forest, out = _Forest(m), []
    for at in range(0, m, SLICE):
        end = min(m, at + SLICE)
        of = np.array([forest.root(x) for x in range(at, m)], dtype=np.int64)
        mine, theirs = of[: end - at], of
        # members connected with the whole slice have nothing to add
        apart = np.flatnonzero(~np.all(theirs[None, :] == mine[:, None], axis=0))
        if not len(apart):
            continue
        others = at + apart
        a, b = sketches[at:end, None, :], sketches[None, others, :]
        same = (a == b).sum(axis=2)
        above = (a > b).sum(axis=2)
        sa, sb = sizes[at:end, None], sizes[None, others]
        fits = 100 * np.minimum(sa, sb) >= percent * np.maximum(sa, sb)
        fits &= np.arange(at, end)[:, None] < others[None, :]
        fits &= mine[:, None] != theirs[None, apart]
        if sides is not None:
            fits &= sides[at:end, None] != sides[None, others]
        fits &= at_least(
            above, sketches.shape[1] - same - above, same, sa, sb, percent / 100 - DOUBT
        )
        x, y = np.nonzero(fits)
        order = np.argsort(-same[x, y], kind="stable")
        _confirm(zip((x[order] + at).tolist(), others[y[order]].tolist()), forest, reps, sets, percent, out)
    return out


def _confirm(pairs, forest, reps, sets, percent, out) -> None:
    """Connect the pairs that are as alike as asked on their full sets and not connected yet."""
    for x, y in pairs:
        rx, ry = forest.root(x), forest.root(y)
        if rx == ry:
            continue
        a, b = sets[x], sets[y]
        if len(a) > len(b):
            a, b = b, a
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        both = int((b[at] == a).sum())
        if 100 * both >= percent * (len(a) + len(b) - both):
            forest.up[max(rx, ry)] = min(rx, ry)
            out.append((reps[x], reps[y]))


def _set_key(found: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        k1 = found.sum(dtype=np.uint64).astype(np.int64)
        k2 = mix64(found ^ np.uint64(77)).sum(dtype=np.uint64).astype(np.int64)
    return int(k1), int(k2)


def _rows(docs: DataFrame) -> DataFrame:
    """_id, _h (of the text), text."""
    return documents(docs).select(null_id("doc_id").alias("_id"), F.xxhash64("text").alias("_h"), "text")


def sketch_documents(docs: DataFrame, registers: int) -> DataFrame:
    """_id, _h, _n (set size), _k1, _k2 (a 128-bit key of the set), _sketch for every document."""

    def sketch(batches):
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = shingles(text)
                regs = to_registers(smallest_hashes(found, registers)) if len(found) else found
                rows.append((len(found), *_set_key(found), regs.tobytes()))
            out = pd.DataFrame(rows, columns=["_n", "_k1", "_k2", "_sketch"])
            out.insert(0, "_id", batch["_id"].to_numpy())
            out.insert(1, "_h", batch["_h"].to_numpy())
            yield out

    return _rows(docs).mapInPandas(
        sketch, "_id bigint, _h bigint, _n bigint, _k1 bigint, _k2 bigint, _sketch binary"
    )


def _bands(reps: DataFrame, rows: int) -> DataFrame:
    """_band (bucket), _rep for each band of each sketch."""

    def deal(batches):
        for batch in batches:
            if not len(batch):
                continue
            regs = np.stack([np.frombuffer(s, dtype=np.uint16) for s in batch["_sketch"]])
            regs = regs.reshape(len(regs), -1, rows).astype(np.uint64)
            with np.errstate(over="ignore"):
                key = np.arange(regs.shape[1], dtype=np.uint64)[None, :] + np.uint64(5)
                for i in range(rows):
                    key = mix64(key ^ (regs[:, :, i] + np.uint64(1) << np.uint64(17)))
            ids = np.repeat(batch["_rep"].to_numpy(), regs.shape[1])
            yield pd.DataFrame({"_band": key.astype(np.int64).ravel(), "_rep": ids})

    return reps.select("_rep", "_sketch").mapInPandas(deal, "_band bigint, _rep bigint")


def classes(docs: DataFrame, percent: int = 85) -> DataFrame:
    """_id, _h (of the text), _n, _root, _first for every row of ``docs``.

    _root: the smallest id among the documents linked with it. _first: it is the first of them.
    """
    ship_code(docs.sparkSession)
    rows = 5 if percent >= 85 else 4
    registers = 125 // rows * rows
    sketched = settle(sketch_documents(docs, registers), "sketches")
    full = sketched.filter("_n > 0")
    # written first, so that the join reads plain shuffles, which Spark can split where a class is hot
    keys = full.groupBy("_k1", "_k2").agg(F.min(F.struct("_id", "_h")).alias("_least"))
    # numbers of the classes, kept by the written table
    keys = settle(keys.select("*", F.monotonically_increasing_id().alias("_rep")), "class_keys")
    mine = (F.col("_id") == F.col("_least._id")) & (F.col("_h") == F.col("_least._h"))
    known = settle(
        full.join(keys, ["_k1", "_k2"]).select(
            "_id", "_h", "_n", "_k1", "_k2", "_rep", "_least", F.when(mine, F.col("_sketch")).alias("_sketch")
        ),
        "classes",
    )
    reps = known.filter("_sketch IS NOT NULL").dropDuplicates(["_rep"])
    bands = settle(_bands(reps, rows), "bands")
    leads = bands.groupBy("_band").agg(F.min("_rep").alias("_lead"), F.count("*").alias("_c"))
    leads = leads.filter("_c > 1").drop("_c")
    near = bands.join(leads, "_band").filter("_rep != _lead").select("_rep", "_lead").distinct()
    clusters = settle(components(near, "_rep", "_lead"), "clusters")
    # the members' sets, made anew from their texts
    members = clusters.join(
        reps.select(F.col("_rep").alias("node"), "_id", "_h", "_n", "_k1", "_k2", "_sketch"), "node"
    )
    weights = members.groupBy("root").agg(
        F.sum(F.col("_n") * 8 + F.length("_sketch")).alias("_bytes"), F.count("*").alias("_members")
    )
    members = members.join(weights, "root").select(
        F.col("node").alias("_rep"), F.col("root").alias("_cluster"), "_id", "_h", "_n", "_k1", "_k2", "_sketch",
        F.ceil(F.greatest(F.col("_bytes") / BLOCK_BYTES, F.col("_members") / BLOCK_MEMBERS)).cast("int").alias("_blocks"),
    )
    # one text of each document; where hashes of texts are equal by chance, the set's key tells them apart
    joined = _rows(docs).dropDuplicates(["_id", "_h"]).join(members, ["_id", "_h"])

    def with_sets(batches):
        for batch in batches:
            found = [shingles(t) for t in batch.pop("text")]
            asked = zip(batch.pop("_k1"), batch.pop("_k2"))
            keep = np.array([_set_key(f) == k for f, k in zip(found, asked)], dtype=bool)
            batch["_set"] = [f.tobytes() for f in found]
            yield batch[keep]

    sets = joined.select("_rep", "_cluster", "_n", "_k1", "_k2", "_sketch", "_blocks", "text").mapInPandas(
        with_sets,
        "_rep bigint, _cluster bigint, _n bigint, _sketch binary, _blocks int, _set binary",
    )
    block = F.pmod(F.xxhash64("_rep"), F.col("_blocks")).cast("int")
    dealt = (
        sets.withColumn("_own", block)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("_x", F.least("_own", "_other"))
        .withColumn("_y", F.greatest("_own", "_other"))
    )

    def confirm(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_rep")
        own, x, y = group["_own"].to_numpy(), group["_x"].iloc[0], group["_y"].iloc[0]
        links = _links(
            group["_rep"].tolist(),
            group["_n"].to_numpy(),
            np.stack([np.frombuffer(s, dtype=np.uint16) for s in group["_sketch"]]),
            [np.frombuffer(s, dtype=np.uint64) for s in group["_set"]],
            None if x == y else (own == x).astype(int),
            percent,
        )
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    confirmed = settle(
        dealt.groupBy("_cluster", "_x", "_y").applyInPandas(confirm, "a bigint, b bigint"), "links"
    )
    roots = components(confirmed, "a", "b").select(F.col("node").alias("_rep"), "root")
    leasts = roots.join(keys.select("_rep", "_least"), "_rep").groupBy("root").agg(F.min("_least").alias("_all"))
    found = roots.join(leasts, "root").select("_rep", "_all")
    linked = known.select("_id", "_h", "_n", "_rep", "_least").join(found, "_rep", "left")
    least = F.coalesce("_all", "_least")
    linked = linked.select(
        "_id", "_h", "_n", least["_id"].alias("_root"),
        ((F.col("_id") == least["_id"]) & (F.col("_h") == least["_h"])).alias("_first"),
    )
    alone = sketched.filter("_n = 0").select("_id", "_h", "_n", F.col("_id").alias("_root"), F.lit(True))
    return linked.union(alone)


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    return classes(docs, percent).select(
        real_id("_id").alias("doc_id"),
        F.col("_n").alias("n_shingles"),
        real_id("_root").alias("component_id"),
        (F.col("_id") == F.col("_root")).alias("kept"),
    )


def keep_first(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of the first document of each group, with all its columns; texts without words all stay."""
    lost = classes(docs, percent).filter("NOT _first").select("_id", "_h").distinct()
    text = F.coalesce("text", F.lit(""))
    # of rows that repeat doc_id and text one stays, the same one in every run
    others = [F.col(f"`{name}`") for name, kind in docs.dtypes if "map<" not in kind]
    document = docs.select(
        null_id(F.col("doc_id").cast("bigint")).alias("_id"),
        F.xxhash64(text).alias("_h"),
        F.xxhash64(*others).alias("_tie"),
        text.rlike("[^\\x20\\x09-\\x0D]").alias("_words"),
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("_row"),
    )
    same = Window.partitionBy("_id", "_h").orderBy("_tie")
    once = document.filter("_words").withColumn("_place", F.row_number().over(same)).filter("_place = 1")
    kept = once.join(lost, ["_id", "_h"], "left_anti").select("_row")
    return kept.union(document.filter("NOT _words").select("_row")).select("_row.*")
