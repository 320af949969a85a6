"""Repeated passages of 50 words, found with a count-min prefilter and exact grouping.

Every window of 50 words belongs to the smallest 8-word gram in it. Each partition counts the
grams of its segments in a count-min sketch; a gram occurs at least as often as any of its windows,
so the merged sketch overestimates every window's count and loses none. The second pass keeps only
segments whose gram is estimated repeated and groups them exactly: equal segments first (a passage
with thousands of copies is one row after map-side aggregation), then the single windows of grams
that have several different segments. Windows are compared by two independent 64-bit hashes, that of
the window and that of its gram.

Cases: a null text has no words; texts under 50 words lose nothing; a window that repeats inside one
document alone stays; rows that share a doc_id are one document for "smaller doc_id"; a null doc_id
is the smallest; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cardlake.llm import anchored
from cardlake.llm.common import documents, forget, null_id, real_id, settle, ship_code, word_hashes

WINDOW = 50
GRAM = 8
_SEGMENT = (
    "_anchor bigint, _sig bigint, _least bigint, _times bigint, _windows binary, _places_of binary"
)
_BLOCK = 1 << 16  # segments of a task in memory at once
_PLACE = np.dtype([("_id", "<i8"), ("_h", "<i8"), ("_first", "<i4"), ("_count", "<i4")])


def _rows(docs: DataFrame) -> DataFrame:
    return documents(docs).select(null_id("doc_id").alias("_id"), F.xxhash64("text").alias("_h"), "text")


def _packed(held: list[tuple], windows: list[bytes]) -> pd.DataFrame:
    """One row for each kind of segment: its least document, how often it came, its windows, its places.

    A passage with very many copies so travels as a few rows of bounded size, not one for each copy.
    """
    anchor, sig, places = (np.concatenate(parts) for parts in zip(*held))
    order = np.lexsort((sig, anchor))
    anchor, sig, places = anchor[order], sig[order], places[order]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (sig[1:] != sig[:-1])))
    cut = np.flatnonzero(new)
    ends = np.append(cut[1:], len(anchor))
    return pd.DataFrame(
        {
            "_anchor": anchor[cut],
            "_sig": sig[cut],
            "_least": np.minimum.reduceat(places["_id"], cut),
            "_times": ends - cut,
            "_windows": [windows[i] for i in order[cut]],
            "_places_of": [places[a:b].tobytes() for a, b in zip(cut, ends)],
        }
    )


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """_id, _h (of the text), _ranges: packed ranges of window starts that a smaller doc_id has too."""
    spark = docs.sparkSession
    ship_code(spark)
    width = window - gram + 1
    rows = _rows(docs)

    def anchors(batches):
        for batch in batches:
            found = [
                anchored.segments(anchored.gram_hashes(word_hashes(t, False), gram), width)[0]
                for t in batch["text"]
            ]
            yield pd.DataFrame(
                {"anchors": [f.tobytes() for f in found], "n": np.array([len(f) for f in found], dtype=np.int64)}
            )

    seen = settle(rows.select("text").mapInPandas(anchors, "anchors binary, n bigint"), "anchors")
    total = seen.agg(F.sum("n")).first()[0] or 0
    bits = anchored.sketch_bits(8 * total)
    table = spark.sparkContext.broadcast(anchored.repeated_anchors(seen.select("anchors"), bits))
    forget(seen)

    def repeated(batches):
        held, windows = [], []
        for batch in batches:
            for doc_id, h, text in zip(batch["_id"].tolist(), batch["_h"].tolist(), batch["text"]):
                words = word_hashes(text, False)
                grams = anchored.gram_hashes(words, gram)
                anchor, first, count = anchored.segments(grams, width)
                keep = np.flatnonzero(anchored.seems_repeated(anchor, table.value, bits))
                if not len(keep):
                    continue
                whole = anchored.gram_hashes(words, window).tobytes()
                begin, n = first[keep], count[keep]
                places = np.empty(len(keep), dtype=_PLACE)
                places["_id"], places["_h"], places["_first"], places["_count"] = doc_id, h, begin, n
                sig = anchored.span_hashes(words, begin, begin + n + window - 1).view(np.int64)
                held.append((anchor[keep].view(np.int64), sig, places))
                windows += [whole[8 * a : 8 * (a + k)] for a, k in zip(begin.tolist(), n.tolist())]
                if len(windows) >= _BLOCK:
                    yield _packed(held, windows)
                    held, windows = [], []
        if windows:
            yield _packed(held, windows)

    found = settle(rows.mapInPandas(repeated, _SEGMENT), "segments")
    same = ["_anchor", "_sig"]
    kinds = found.groupBy(*same).agg(
        F.min("_least").alias("_least"), F.sum("_times").alias("_times"), F.first("_windows").alias("_windows")
    )
    kinds = settle(kinds, "segment_kinds")
    of_anchor = kinds.groupBy("_anchor").agg(F.count("*").alias("_kinds"), F.sum("_times").alias("_all"))
    several = of_anchor.filter("_kinds > 1").select("_anchor")

    def singles(batches):
        for batch in batches:
            parts = [np.frombuffer(w, dtype=np.int64) for w in batch["_windows"]]
            n = np.array([len(p) for p in parts], dtype=np.int64)
            if not len(n):
                continue
            yield pd.DataFrame(
                {
                    "_anchor": np.repeat(batch["_anchor"].to_numpy(), n),
                    "_sig": np.repeat(batch["_sig"].to_numpy(), n),
                    "_least": np.repeat(batch["_least"].to_numpy(), n),
                    "_i": np.concatenate([np.arange(k, dtype=np.int32) for k in n]),
                    "_w": np.concatenate(parts),
                }
            )

    apart = kinds.join(several, "_anchor", "left_semi").mapInPandas(
        singles, "_anchor bigint, _sig bigint, _least bigint, _i int, _w bigint"
    )
    apart = settle(apart, "single_windows")
    least = apart.groupBy("_anchor", "_w").agg(F.min("_least").alias("_min"), F.max("_least").alias("_max"))
    later = apart.join(least.filter("_min < _max"), ["_anchor", "_w"]).filter("_least > _min")
    some = later.groupBy(*same).agg(F.collect_set("_i").alias("_places"))  # a segment's windows at most
    judged = kinds.filter("_times > 1").select(*same, "_least").join(some, same, "full")
    judged = judged.select(*same, F.coalesce("_least", F.lit(None).cast("bigint")).alias("_least"), "_places")
    # written first, so that the join reads plain shuffles, which Spark can split where a passage is hot
    judged = settle(judged, "judged")
    forget(kinds, apart)
    met = found.select(*same, "_places_of").join(judged, same)
    spans = settle(_ranges_of_documents(met), "repeated_ranges")
    forget(found, judged)
    return spans


def _ranges_of_documents(met: DataFrame) -> DataFrame:
    """_id, _h, _ranges from segments with their verdict: all windows of later documents, else _places."""

    def unpack(batches):
        for batch in batches:
            ids, hashes, ranges = [], [], []
            for packed, least, inner in zip(batch["_places_of"], batch["_least"].tolist(), batch["_places"]):
                at = np.frombuffer(packed, dtype=_PLACE)
                later = at["_id"] > least
                whole, part = at[later], at[~later]
                start = whole["_first"].astype(np.int64)
                ids.append(whole["_id"])
                hashes.append(whole["_h"])
                ranges.append((start << 32) + start + whole["_count"] - 1)
                if inner is not None and len(inner) and len(part):
                    start = (part["_first"].astype(np.int64)[:, None] + np.asarray(inner, dtype=np.int64)).ravel()
                    ids.append(np.repeat(part["_id"], len(inner)))
                    hashes.append(np.repeat(part["_h"], len(inner)))
                    ranges.append((start << 32) + start)
            if not ids:
                continue
            table = pd.DataFrame(
                {"_id": np.concatenate(ids), "_h": np.concatenate(hashes), "_r": np.concatenate(ranges)}
            )
            if len(table):
                yield table.groupby(["_id", "_h"])["_r"].agg(list).rename("_ranges").reset_index()

    # a segment that occurs once has no smaller document: no id is larger than the largest number
    least = F.coalesce("_least", F.lit((1 << 63) - 1)).alias("_least")
    rows = met.select("_places_of", least, "_places")
    found = rows.mapInPandas(unpack, "_id bigint, _h bigint, _ranges array<bigint>")
    return found.groupBy("_id", "_h").agg(F.flatten(F.collect_list("_ranges")).alias("_ranges"))


def _judge(docs: DataFrame, judge: Callable, schema: str, columns: list, window: int) -> DataFrame:
    """Each row with the ranges of its removed windows, handed to ``judge(batch)``."""
    spans = repeated_windows(docs, window)
    rows = docs.select(*columns, null_id(F.col("doc_id").cast("bigint")).alias("_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h"))

    def run(batches):
        for batch in batches:
            yield judge(batch)

    return rows.join(spans, ["_id", "_h"], "left").mapInPandas(run, schema)


def without(text: str | None, ranges, window: int) -> tuple[int, int, bytes]:
    """Words, removed words, and the kept words joined by one space."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if ranges is None or not len(ranges):
        return len(words), 0, b" ".join(words)
    gone = anchored.covered(len(words), ranges, window)
    return len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone.tolist()) if not g)


def removed_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every document."""

    def judge(batch):
        rows = []
        for doc_id, text, ranges in zip(batch["_id"], batch["_text"], batch["_ranges"]):
            n, gone, kept = without(text, ranges, window)
            rows.append((doc_id, n, gone, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(rows, columns=["_id", "n_words", "n_removed", "kept_sha256"])

    out = _judge(
        docs, judge, "_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
        [F.col("text").alias("_text")], window,
    )
    return out.select(real_id("_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with all their columns, repeated passages cut from ``text``.

    A text that loses words is its kept words joined by one space, and n_chars, where there is such
    a column, its new length; other texts stay as they are.
    """
    names = docs.columns
    # positional names meanwhile, so that no column can clash with those of the join
    inner = [f"_c{i}" for i in range(len(names))]
    schema = StructType([StructField(c, f.dataType, True) for c, f in zip(inner, docs.schema)])
    text_at, size_at = inner[names.index("text")], None
    if "n_chars" in names:
        size_at = inner[names.index("n_chars")]

    def judge(batch):
        texts = []
        for text, ranges in zip(batch[text_at], batch["_ranges"]):
            if ranges is not None and len(ranges):
                text = without(text, ranges, window)[2].decode("utf-8", "surrogatepass")
            texts.append(text)
        if size_at:
            lost = batch["_ranges"].notna()
            batch[size_at] = batch[size_at].astype("Int64")
            batch.loc[lost, size_at] = [len(t) for t, x in zip(texts, lost) if x]
        batch[text_at] = texts
        return batch[inner]

    columns = [F.col(f"`{name}`").alias(c) for name, c in zip(names, inner)]
    return _judge(docs, judge, schema, columns, window).toDF(*names)
