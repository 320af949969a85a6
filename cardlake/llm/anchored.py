"""Windows of a sequence dealt out by content: each window belongs to its smallest inner gram.

Two equal windows have the same smallest gram at the same offset, so they share its hash, the anchor.
Neighbouring windows mostly share one occurrence of it; such a run is a segment.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import _power_table, mix64

_PLACE = 24  # bits of a position in a sort key; longer sequences are taken in pieces
_SLICE = 20  # bits of a cell's place in its slice of the sketch
DEPTH = 2


def gram_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of all runs of ``length`` values (unsigned words), one for each start."""
    n = len(values)
    if n < length:
        return np.zeros(0, dtype=np.uint64)
    up, down = _power_table(n + 1)
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * up[:n], out=prefix[1:])
        return mix64((prefix[length:] - prefix[:-length]) * down[: n - length + 1] + np.uint64(length))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[start:end], with the length."""
    n = len(values)
    up, down = _power_table(n + 1)
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * up[:n], out=prefix[1:])
        return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _smallest(grams: np.ndarray, width: int) -> np.ndarray:
    n = len(grams)
    mask = np.uint64((1 << _PLACE) - 1)
    key = (grams & ~mask) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64((1 << 64) - 1))
    padded[:n] = key
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[: n - width + 1], ahead[width - 1 : n]) & mask).astype(np.int64)


def anchor_places(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` grams the place of its smallest one, the first of equals."""
    if len(grams) < width:
        return np.zeros(0, dtype=np.int64)
    most = (1 << _PLACE) - width
    if len(grams) <= most:
        return _smallest(grams, width)
    return np.concatenate(
        [
            _smallest(grams[at : at + most], width) + at
            for at in range(0, len(grams) - width + 1, most - width + 1)
        ]
    )


def segments(grams: np.ndarray, width: int):
    """anchor hashes, first windows and numbers of windows of the segments, in order."""
    places = anchor_places(grams, width)
    if not len(places):
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
    return grams[places[first]], first, np.diff(np.append(first, len(places)))


def sketch_cells(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cells of one row of the count-min sketch that anchors fall into."""
    return mix64(anchors ^ np.uint64(0xA5A5 + row)) >> np.uint64(64 - bits)


def sketch_bits(windows: int) -> int:
    """Cells for the expected number of anchors, as a power of two: from 2**20 to 2**30."""
    return min(30, max(_SLICE, int(windows).bit_length()))


def repeated_anchors(anchors: DataFrame, bits: int) -> list[np.ndarray]:
    """For each row of the sketch a bit per cell: counted twice or more.

    anchors: rows of ``anchors`` (binary, unsigned words). Each partition counts its own cells,
    capped at two, since more is not asked; slices of the merged sketch are added up in tasks. The
    driver gets one bit per cell, 2**bits / 8 bytes for each row, 128 MB at most.
    """

    def count(batches):
        found = [np.frombuffer(b, dtype=np.uint64) for batch in batches for b in batch["anchors"]]
        found = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
        for row in range(DEPTH):
            cells = np.sort(sketch_cells(found, row, bits))
            if not len(cells):
                continue
            first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
            twice = (np.diff(np.append(first, len(cells))) > 1).astype(np.uint8)
            cells = cells[first]
            slices = (cells >> np.uint64(_SLICE)).astype(np.int64)
            inner = (cells & np.uint64((1 << _SLICE) - 1)).astype(np.uint32)
            cut = np.flatnonzero(np.concatenate(([True], slices[1:] != slices[:-1])))
            ends = np.append(cut[1:], len(cells))
            yield pd.DataFrame(
                {
                    "row": row,
                    "slice": slices[cut].astype(np.int32),
                    "cells": [inner[a:b].tobytes() for a, b in zip(cut, ends)],
                    "twice": [twice[a:b].tobytes() for a, b in zip(cut, ends)],
                }
            )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << _SLICE, dtype=np.uint8)
        for cells, twice in zip(group["cells"], group["twice"]):
            at = np.frombuffer(cells, dtype=np.uint32)
            total[at] = np.minimum(2, total[at] + 1 + np.frombuffer(twice, dtype=np.uint8))
        out = group[["row", "slice"]].iloc[:1].copy()
        out["bits"] = [np.packbits(total > 1).tobytes()]
        return out

    merged = (
        anchors.mapInPandas(count, "row int, slice int, cells binary, twice binary")
        .groupBy("row", "slice")
        .applyInPandas(add, "row int, slice int, bits binary")
    )
    table = [np.zeros((1 << bits) // 8, dtype=np.uint8) for _ in range(DEPTH)]
    size = (1 << _SLICE) // 8
    for r in merged.toLocalIterator():
        table[r["row"]][r["slice"] * size : (r["slice"] + 1) * size] = np.frombuffer(r["bits"], dtype=np.uint8)
    return table


def seems_repeated(anchors: np.ndarray, table: list[np.ndarray], bits: int) -> np.ndarray:
    """Whether the sketch estimates a count of two or more; never false for a repeated anchor."""
    keep = np.ones(len(anchors), dtype=bool)
    for row, packed in enumerate(table):
        cells = sketch_cells(anchors, row, bits)
        byte = packed[(cells >> np.uint64(3)).astype(np.int64)]
        keep &= (byte >> (np.uint8(7) - (cells & np.uint64(7)).astype(np.uint8)) & np.uint8(1)).astype(bool)
    return keep


def ranges_by_document(found: DataFrame) -> DataFrame:
    """_id, _h, _ranges: the ranges (_s, _e) of each document in one row, each as _s * 2**32 + _e."""
    packed = F.shiftleft(F.col("_s").cast("bigint"), 32) + F.col("_e")
    return found.groupBy("_id", "_h").agg(F.collect_list(packed).alias("_ranges"))


def covered(n: int, ranges, width: int) -> np.ndarray:
    """Which of n places lie in a window that starts in one of the ranges (both ends included)."""
    step = np.zeros(n + 1, dtype=np.int64)
    if ranges is not None and len(ranges):
        packed = np.asarray(ranges, dtype=np.int64)
        np.add.at(step, packed >> 32, 1)
        np.add.at(step, np.minimum((packed & 0xFFFFFFFF) + width, n), -1)
    return np.cumsum(step[:-1]) > 0
