"""Packing of token sequences by minimum bin slack.

Texts are tokenized by Spark tasks; each becomes its ids and one closing id. A document longer than a
sequence is cut into full pieces, the remainder first. What the packing needs is the count of pieces
of each length, a table of at most ``capacity`` rows. For each bin a bitset subset-sum over the
available lengths, the longest always in, finds the fullest combination; it is removed as often as
the counts allow, so the number of rounds depends on the lengths and not on the rows. Pieces learn
their place from their rank among the pieces of their length, a distributed ordinal, so one length
may hold any share of all rows.

Cases: a null or empty text is the closing id alone; repeated rows are packed like any other; a null
doc_id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import dense_key, documents, settle

CAPACITY = 2048
CLOSING_ID = 0
# Fixed value: the published split pattern of byte-level BPE.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
LONG_RUN = re.compile(r"\S{4000}")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordTokenizer:
    """Ids of whole texts as the tokenizers file defines them.

    For a plain byte-level BPE file the same vocabulary also drives the tiktoken encoder, which gives
    the same ids four times as fast; the first texts in each worker are encoded by both and must agree.
    Texts that spell a special token or hold a very long run without blanks, and all texts of other
    kinds of files, go through tokenizers itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast, self.agreed = self._same_vocabulary(path), 0

    def _same_vocabulary(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and not spec.get("normalizer") and not model.get("dropout")
        split = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"]
        if not (plain and split and not model.get("ignore_merges")):
            return None
        import tiktoken

        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in piece): number
            for piece, number in model["vocab"].items()
            if piece not in self.special
        }
        return tiktoken.Encoding("same", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self.fast is None:
            return self._whole(texts)
        out = []
        for text in texts:
            if any(s in text for s in self.special) or LONG_RUN.search(text):
                out += self._whole([text])
                continue
            out.append(array("I", self.fast.encode_ordinary(text)).tobytes())
            if self.agreed < 20:
                if self._whole([text])[0] != out[-1]:
                    raise ValueError("the two encoders of this tokenizer file differ")
                self.agreed += 1
        return out


_loaded: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def chunks(texts: list[str], most: int = 4_000_000):
    """Ranges of texts with a bounded number of characters together."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""

    def cut(batches):
        encoder = word_tokenizer(tokenizer_path)
        closing = array("I", [CLOSING_ID]).tobytes()
        for batch in batches:
            ids, texts, out = batch["doc_id"].tolist(), batch["text"].tolist(), []
            for a, b in chunks(texts):
                for doc_id, raw in zip(ids[a:b], encoder.encode(texts[a:b])):
                    raw += closing
                    n, view, start = len(raw) // 4, memoryview(raw), 0
                    first = (n - 1) % capacity + 1
                    for number in range(-(-n // capacity)):
                        end = first + number * capacity
                        crc = zlib.crc32(view[4 * start : 4 * end])
                        out.append((doc_id, number, start, end - start, crc))
                        start = end
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return documents(docs).mapInPandas(cut, PIECES)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The combination of available lengths with the longest one in it that leaves least room."""
    lengths = sorted(counts, reverse=True)
    room = capacity - lengths[0]
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in lengths:
        copies = counts[length] - (length == lengths[0])
        for _ in range(min(copies, room // length)):
            wider = (reach | (reach << length)) & mask
            if wider == reach:
                break
            steps.append((length, reach))
            reach = wider
        if reach >> room & 1:
            break
    left, taken = reach.bit_length() - 1, {lengths[0]: 1}
    for length, before in reversed(steps):
        if not before >> left & 1:
            taken[length] = taken.get(length, 0) + 1
            left -= length
    return taken


def minimum_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(how often, combination) until nothing is left."""
    counts, bins = {k: v for k, v in counts.items() if v}, []
    while counts:
        taken = fullest(counts, capacity)
        times = min(counts[k] // n for k, n in taken.items())
        for length, n in taken.items():
            counts[length] -= times * n
            if not counts[length]:
                del counts[length]
        bins.append((times, taken))
    return bins


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (any rows with doc_id, piece and length)."""
    names = cut.columns
    ranked = dense_key(cut, [F.col("length"), F.col("doc_id"), F.col("piece")], "_row", 0)
    ranked = settle(ranked, "ranked_pieces")
    counts = {r["length"]: r["count"] for r in ranked.groupBy("length").count().collect()}
    firsts, total = {}, 0
    for length in sorted(counts):
        firsts[length] = total
        total += counts[length]
    table, sequence, used = [], 0, dict(firsts)
    for times, taken in minimum_slack(counts, capacity):
        offset = 0
        for length, n in taken.items():
            table.append((used[length], sequence, n, offset))
            used[length] += times * n
            offset += n * length
        sequence += times
    begin, base, each, shift = (
        np.array(c, dtype=np.int64) for c in (zip(*sorted(table)) if table else ([0], [0], [1], [0]))
    )

    def place(batches):
        for batch in batches:
            row = batch.pop("_row").to_numpy()
            at = np.searchsorted(begin, row, side="right") - 1
            which = row - begin[at]
            batch["sequence_id"] = base[at] + which // each[at]
            batch["offset"] = shift[at] + which % each[at] * batch["length"].to_numpy()
            yield batch

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.select(*names, "_row").mapInPandas(
        place, f"{kinds}, sequence_id bigint, offset bigint"
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every text."""
    return pack(settle(pieces(docs, tokenizer_path, capacity), "pieces"), capacity)
