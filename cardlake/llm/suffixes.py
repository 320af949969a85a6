"""Repeated byte strings found by merging Burrows-Wheeler transforms of shards.

Which suffixes can share 100 bytes is settled first. Every 100-byte window belongs to the smallest
40-byte gram in it; windows around one occurrence of it form a segment. Segments whose gram is
counted once by a count-min sketch can't repeat. Equal segments collapse to one kind with its first
place (thousands of copies are one row after map-side aggregation): all later copies are repeats. The
kinds of grams that have several go to buckets. Where a gram has very many kinds, their windows are
dealt by the gram and how far it lies from a window's start, in a few ranges: all windows of a range reach
some bytes beyond the gram on both sides, which join the key. Pieces that are equal then collapse to the
one with the first place, by their bytes, before any key goes to a task; keys that still have very many
kinds are split again, until whole windows are the key and one kind each is left. So a task gets a
bounded number of strings of a key, whatever a passage is shared by. In a bucket, shards of kinds are suffix-sorted to the needed depth and their transforms merged two by two:
the interleave of both orders is refined one symbol (five bytes) at a time by a stable distribution of
the transforms' symbols, which also yields the common prefixes of neighbours; no suffix is sorted
again. Intervals of suffixes with a common prefix of 100 bytes are the repeats; in each, all but the
first in (doc_id, start) go.

Cases: a null text is empty; texts under 100 bytes lose nothing; overlapping repeats inside one
document count; matches never cross documents; rows that repeat both doc_id and text are one document;
a null doc_id is the smallest; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm import anchored
from cardlake.llm.common import _BYTE, documents, forget, null_id, real_id, settle, ship_code

WINDOW = 100
GRAM = 40
UNIT = 5  # bytes of one symbol while transforms are merged
BUCKET_BYTES = 1 << 19
SHARD_BYTES = 1 << 20
HOT = 4096  # kinds of one key beyond which its windows are dealt by what stands beside the gram
PARTS = 4  # ranges that the windows of such a key are dealt to at a time
_SEGMENT = "_id bigint, _h bigint, _anchor bigint, _sig bigint, _first int, _count int"


class Transform:
    """Suffixes of a set of strings, sorted to a depth, with their transform.

    ``bwt`` holds the symbol before each suffix (0: the string begins there), ``back`` the place in the
    order of the suffix that is longer by this symbol, ``place`` the position in the concatenation of
    the strings, each with one end mark. End marks of different strings differ, in their order.
    """

    def __init__(self, bwt: np.ndarray, back: np.ndarray, place: np.ndarray):
        self.bwt, self.back, self.place = bwt, back, place


def shard_transform(symbols: np.ndarray, ends: np.ndarray, depth: int) -> Transform:
    """The transform of a shard by tripling ranks.

    symbols: the strings with a 0 at each of ``ends``, their end marks; other symbols are positive.
    """
    n, strings = len(symbols), len(ends)
    rank = symbols.astype(np.uint64) + np.uint64(strings)
    rank[ends] = np.arange(strings, dtype=np.uint64)
    have = 1
    while True:
        base = rank.max() + np.uint64(1)
        steps = [min(have, depth - have)] if have < depth else [0]
        if int(base) ** 3 < 1 << 64 and have + steps[0] < depth:
            steps.append(min(2 * have, depth - have))
        key = rank
        for step in steps:
            ahead = np.zeros(n, dtype=np.uint64)
            ahead[: n - step] = rank[step:]
            key = key * base + ahead
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        start = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = (np.cumsum(start) - 1).astype(np.uint64)
        have += steps[-1]
        if have >= depth or start.all():
            break
    where = np.empty(n, dtype=np.int32)
    where[order] = np.arange(n, dtype=np.int32)
    return Transform(symbols[order - 1] * (order > 0), where[order - 1], order)


def merge(shards: list[Transform], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The repeated intervals of the merged transform.

    Returns the suffixes (numbered through the shards, in each by its order) that share their first
    ``depth`` symbols with another one, in merged order, and which of them start a new interval.

    The interleave begins as one shard after the other. Round h deals the suffixes out by the symbols
    before them, stably, which interleaves them by their first h symbols; neighbours whose symbol or
    last interval differ have a common prefix under h. A suffix alone in its interval has no longer
    common prefix, nor has any suffix that ends with it, so it takes no part in later rounds.
    """
    begins = np.cumsum([0] + [len(t.bwt) for t in shards])
    bwt = np.concatenate([t.bwt for t in shards])
    back = np.concatenate([t.back + np.int32(b) for t, b in zip(shards, begins)])
    row = np.arange(begins[-1], dtype=np.int32)
    block, start = np.zeros(len(row), dtype=np.int32), np.ones(0, dtype=bool)
    for _ in range(depth):
        symbol = bwt[row]
        inner = symbol > 0
        row, symbol, block = row[inner], symbol[inner], block[inner]
        order = np.argsort(symbol, kind="stable")
        row, symbol, block = back[row[order]], symbol[order], block[order]
        start = np.ones(len(row) + 1, dtype=bool)
        start[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        shared = ~(start[:-1] & start[1:])
        row, start = row[shared], start[:-1][shared]
        block = np.cumsum(start, dtype=np.int32)
    return row, start


def intervals(strings: list[bytes], depth: int, shard_bytes: int = SHARD_BYTES, unit: int = 1):
    """Byte places of the suffixes that share their first ``depth`` bytes with another, in merged order,
    and which of them start a new interval. Places count in the concatenation of the strings.

    With ``unit`` over 1 (a divisor of ``depth``), that many bytes are one symbol: a string becomes
    ``unit`` strings, one for each phase, so every byte place is still the start of one suffix, and
    merging takes depth / unit rounds.
    """
    if depth % unit or unit > 7:
        raise ValueError("the unit must divide the depth and be at most 7 bytes")
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    lengths = np.array([len(s) for s in strings], dtype=np.int64)
    begins = np.cumsum(lengths) - lengths
    # all whole symbols, by the byte at which they start
    words = np.zeros(len(data), dtype=np.uint64)
    for i in range(unit):
        words[: max(0, len(data) - i)] |= data[i:].astype(np.uint64) << np.uint64(8 * (unit - 1 - i))
    alphabet, number = np.sort(words), None
    alphabet = alphabet[np.concatenate(([True], alphabet[1:] != alphabet[:-1]))] if len(data) else words
    number = np.searchsorted(alphabet, words) + 1
    kind = np.uint16 if len(alphabet) < (1 << 16) - 1 else np.uint32
    # phase strings: (first byte, number of symbols)
    phase = np.tile(np.arange(unit), len(strings))
    own = np.repeat(np.arange(len(strings)), unit)
    count = np.maximum(0, (lengths[own] - phase) // unit)
    first = begins[own] + phase
    shard, size = [], 0
    limit = min(shard_bytes, (len(data) + len(count)) // 2 + 1)  # two shards at least
    cuts = [0]
    for i, n in enumerate(count.tolist()):
        if size and size + n > limit:
            cuts.append(i)
            size = 0
        size += n + 1
    cuts.append(len(count))
    at = []
    for x, y in zip(cuts[:-1], cuts[1:]):
        if x == y:
            continue
        sizes = count[x:y] + 1
        ends = np.cumsum(sizes) - 1
        inner = np.arange(int(ends[-1]) + 1) - np.repeat(ends + 1 - sizes, sizes)
        byte = np.repeat(first[x:y], sizes) + unit * inner
        symbols = np.zeros(len(byte), dtype=kind)
        real = np.ones(len(byte), dtype=bool)
        real[ends] = False
        symbols[real] = number[byte[real]]
        shard.append(shard_transform(symbols, ends, depth // unit))
        at.append(np.where(real, byte, -1))
    if not shard:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    row, start = merge(shard, depth // unit)
    return np.concatenate([a[t.place] for a, t in zip(at, shard)])[row], start


def later_windows(payloads: list[bytes], ids: np.ndarray, firsts: np.ndarray, window: int):
    """For each string the offsets of windows that some earlier window equals.

    ids, firsts: document and start of each string's first byte; earlier is by both, in that order.
    """
    place, start = intervals(payloads, window, unit=UNIT if window % UNIT == 0 else 1)
    lengths = np.array([len(p) for p in payloads], dtype=np.int64)
    offsets = np.cumsum(lengths) - lengths
    of = np.searchsorted(offsets, place, side="right") - 1  # no string is empty
    inner = place - offsets[of]
    group = np.cumsum(start)
    order = np.lexsort((firsts[of] + inner, ids[of], group))
    group, of, inner = group[order], of[order], inner[order]
    at = (ids[of], firsts[of] + inner)
    again = np.zeros(len(group), dtype=bool)
    again[1:] = group[1:] == group[:-1]
    head = np.maximum.accumulate(np.where(again, 0, np.arange(len(group)))) if len(group) else of
    same = again & (at[0] == at[0][head]) & (at[1] == at[1][head])  # the very same place
    return of[again & ~same], inner[again & ~same]


def narrower(piece: bytes, at: int, low: int, high: int, window: int, gram: int):
    """The windows of a piece dealt to narrower ranges, with the bytes around the gram that they share.

    at: the gram's place in the piece, whose windows have it at some of the places from low to high.
    Yields key, low, high, the first window's place in the piece, the gram's place and the bytes of each.
    """
    last = at + window - len(piece)  # where the last window has the gram
    step = -(-(high - low + 1) // PARTS)
    for x in range(low, high + 1, step):
        y = min(high, x + step - 1)
        far, near = min(y, at), max(x, last)
        if near <= far:
            shared = piece[at - x : at + window - y]
            key = hashlib.blake2b(shared + b"%d %d" % (x, y), digest_size=8).digest()
            begin = at - far
            yield int.from_bytes(key, "big", signed=True), x, y, begin, far, piece[begin : at - near + window]


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """_id, _h (of the text), _ranges: packed ranges of window starts that also start earlier."""
    spark = docs.sparkSession
    ship_code(spark)
    width = window - gram + 1
    rows = documents(docs).select(null_id("doc_id").alias("_id"), F.xxhash64("text").alias("_h"), "text")

    def cut(text):
        values = _BYTE[np.frombuffer(_bytes(text), dtype=np.uint8)]
        return values, *anchored.segments(anchored.gram_hashes(values, gram), width)

    def anchors(batches):
        for batch in batches:
            found = [cut(t)[1] for t in batch["text"]]
            yield pd.DataFrame(
                {"anchors": [f.tobytes() for f in found], "n": np.array([len(f) for f in found], dtype=np.int64)}
            )

    seen = settle(rows.select("text").mapInPandas(anchors, "anchors binary, n bigint"), "anchors")
    total = seen.agg(F.sum("n")).first()[0] or 0
    bits = anchored.sketch_bits(8 * total)
    table = spark.sparkContext.broadcast(anchored.repeated_anchors(seen.select("anchors"), bits))
    forget(seen)

    def repeated(batches):
        for batch in batches:
            parts = []
            for doc_id, h, text in zip(batch["_id"].tolist(), batch["_h"].tolist(), batch["text"]):
                values, anchor, first, count = cut(text)
                keep = np.flatnonzero(anchored.seems_repeated(anchor, table.value, bits))
                if not len(keep):
                    continue
                first, count = first[keep], count[keep]
                sig = anchored.span_hashes(values, first, first + count + window - 1)
                one = np.ones(len(keep), dtype=np.int64)
                parts.append((doc_id * one, h * one, anchor[keep].view(np.int64), sig.view(np.int64), first, count))
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts)]
                frame = pd.DataFrame(dict(zip(("_id", "_h", "_anchor", "_sig", "_first", "_count"), columns)))
                yield frame.astype({"_first": np.int32, "_count": np.int32})

    found = settle(rows.mapInPandas(repeated, _SEGMENT), "segments")
    same = ["_anchor", "_sig"]
    kinds = found.groupBy(*same).agg(
        F.min(F.struct("_id", "_first", "_h", "_count")).alias("_least"), F.count("*").alias("_times")
    )
    kinds = settle(kinds, "segment_kinds")
    several = kinds.groupBy("_anchor").agg(F.count("*").alias("_kinds")).filter("_kinds > 1")
    several = settle(several.select("_anchor", (F.col("_kinds") > hot).alias("_hot")), "several_kinds")
    wanted = settle(kinds.join(several, "_anchor").select(*same, "_hot", "_least.*"), "wanted_segments")
    weight = wanted.filter("NOT _hot").agg(F.sum(F.col("_count") + window)).first()[0] or 0
    lists = wanted.groupBy("_id", "_h").agg(
        F.collect_list(F.struct(*same, "_hot", "_first", "_count")).alias("_list")
    )  # a document's own segments

    def take(batches):
        for batch in batches:
            out = []
            for doc_id, text, asked in zip(batch["_id"], batch["text"], batch["_list"]):
                raw = _bytes(text)
                for r in asked:
                    first, key = r["_first"], r["_anchor"]
                    part = raw[first : first + r["_count"] + window - 1]
                    at = 0  # where the gram lies matters to hot ones alone
                    if r["_hot"]:
                        values = _BYTE[np.frombuffer(part, dtype=np.uint8)]
                        at = int(np.flatnonzero(anchored.gram_hashes(values, gram).view(np.int64) == key)[0])
                    out.append((key, 0, width - 1, at, r["_hot"], key, r["_sig"], doc_id, first, 0, part))
            yield pd.DataFrame(out, columns=names)

    def deal(batches):
        for batch in batches:
            out = []
            for r in batch[names].itertuples(index=False, name=None):
                _, low, high, at, _, *kind, doc_id, start, shift, part = r
                for key, x, y, begin, place, piece in narrower(part, at, low, high, window, gram):
                    out.append((key, x, y, place, True, *kind, doc_id, start + begin, shift + begin, piece))
            yield pd.DataFrame(out, columns=names)

    schema = (
        "_key bigint, _low int, _high int, _at int, _hot boolean, _anchor bigint, _sig bigint, "
        "_id bigint, _start int, _shift int, _bytes binary"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    strings = (
        rows.join(lists, ["_id", "_h"])
        .dropDuplicates(["_id", "_h"])
        .select("_id", "text", "_list")
        .mapInPandas(take, schema)
    )
    later, done = [], []
    if several.filter("_hot").limit(1).count():
        strings = settle(strings, "segment_bytes")
        done.append(strings)
        wide, strings = strings.filter("_hot"), strings.filter("NOT _hot")
        key = ["_key", "_low", "_high"]
        while wide.limit(1).count():
            pieces = settle(wide.mapInPandas(deal, schema), "pieces")
            alike = pieces.groupBy(*key, "_bytes").agg(
                F.min(F.struct("_id", "_start", "_at", "_anchor", "_sig", "_shift")).alias("_least"),
                F.count("*").alias("_times"),
            )
            alike = settle(alike, "piece_kinds")
            copied = alike.filter("_times > 1").select(
                *key, "_bytes", F.col("_least._id").alias("_l"), F.col("_least._start").alias("_f")
            )
            copies = pieces.join(copied, [*key, "_bytes"]).filter("_id != _l OR _start != _f")
            until = F.col("_shift") + F.length("_bytes") - window
            later.append(settle(copies.select(*same, F.col("_shift").alias("_place"), until.alias("_until")), "copies"))
            number = alike.groupBy(*key).agg(F.count("*").alias("_kinds")).filter("_kinds > 1")
            left = alike.join(number, key).select(
                *key, "_least.*", ((F.col("_kinds") > hot) & (F.col("_low") < F.col("_high"))).alias("_hot"), "_bytes"
            )
            left = settle(left.select(*names), "pieces_left")
            forget(pieces, alike)
            done += [left, later[-1]]
            weight += left.filter("NOT _hot").agg(F.sum(F.length("_bytes"))).first()[0] or 0
            strings, wide = strings.union(left.filter("NOT _hot")), left.filter("_hot")
    buckets = max(1, math.ceil(weight / BUCKET_BYTES))
    strings = strings.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)))

    def resolve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["_key", "_sig"])
        shift = group["_shift"].to_numpy().astype(np.int64)
        starts = group["_start"].to_numpy().astype(np.int64)
        string, offset = later_windows(group["_bytes"].tolist(), group["_id"].to_numpy(), starts, window)
        out = group[["_anchor", "_sig"]].iloc[string].copy()
        out["_place"] = out["_until"] = (shift[string] + offset).astype(np.int32)
        return out

    places = strings.groupBy("_bucket").applyInPandas(
        resolve, "_anchor bigint, _sig bigint, _place int, _until int"
    )
    for copies in later:
        places = places.union(copies)
    some = places.groupBy(*same).agg(F.collect_set(F.struct("_place", "_until")).alias("_places"))
    judged = kinds.select(*same, "_times", F.col("_least._id").alias("_l"), F.col("_least._first").alias("_f"))
    judged = settle(judged.join(some, same, "left").filter("_times > 1 OR _places IS NOT NULL"), "judged")
    forget(kinds, several, wanted, *done)
    met = found.join(judged, same)
    begin = F.col("_first")
    everything = F.array(F.struct(begin.alias("_s"), (begin + F.col("_count") - 1).alias("_e")))
    single = F.transform(
        "_places", lambda p: F.struct((begin + p["_place"]).alias("_s"), (begin + p["_until"]).alias("_e"))
    )
    first = (F.col("_id") == F.col("_l")) & (F.col("_first") == F.col("_f"))
    ranges = met.select("_id", "_h", F.inline(F.when(first, single).otherwise(everything)))
    spans = settle(anchored.ranges_by_document(ranges), "repeated_ranges")
    forget(found, judged)
    return spans


def kept_bytes(text: str | None, ranges, window: int) -> tuple[int, int, int, bytes]:
    """Bytes, removed bytes, maximal removed runs, and what is left."""
    raw = _bytes(text)
    if ranges is None or not len(ranges):
        return len(raw), 0, 0, raw
    gone = anchored.covered(len(raw), ranges, window)
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return len(raw), int(gone.sum()), runs, np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes."""
    spans = repeated_windows(docs, window)
    rows = documents(docs).select(null_id("doc_id").alias("_id"), F.xxhash64("text").alias("_h"), "text")
    names = ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if with_bytes else 5]

    def judge(batches):
        for batch in batches:
            out = []
            for doc_id, text, ranges in zip(batch["_id"], batch["text"], batch["_ranges"]):
                *numbers, kept = kept_bytes(text, ranges, window)
                out.append((doc_id, *numbers, hashlib.sha256(kept).hexdigest(), kept)[: len(names)])
            yield pd.DataFrame(out, columns=names)

    schema = "_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    judged = rows.join(spans, ["_id", "_h"], "left").mapInPandas(
        judge, schema + (", kept binary" if with_bytes else "")
    )
    return judged.select(real_id("_id").alias("doc_id"), *judged.columns[1:])
