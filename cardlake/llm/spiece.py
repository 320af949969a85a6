"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is read field by field. From it come the normaliser (character map, blanks, the
metaspace marker), the pieces with their scores, and byte fallback; a unigram model keeps its scores, in
a BPE model the merge that makes a piece ranks by that piece's score. Where no piece holds a marker
behind another character, a text may be cut before each run of markers; parts are encoded once per
worker, in multithreaded batches, and remembered. Parity with the sentencepiece library and the round trip
(the decoded ids against the text) are checked on every whole text.

Cases: a null or empty text has no tokens; unknown characters become their bytes, or the unknown piece
where a model has no bytes; control pieces spelled out in a text are ordinary characters; a text that
holds the marker itself, or that the normaliser changes, does not come back as it was (round_trip false);
very long texts are encoded whole, in parts; repeated rows are encoded each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array

import pandas as pd
from pyspark.sql import DataFrame

from cardlake.llm.common import documents, ship_code
from cardlake.llm.packing import chunks

MARK = "▁"
THREADS = 2
ROOM = 1_000_000  # remembered parts in a worker, some 150 MB
# Fixed values of the published model format: field numbers, piece kinds, model types.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _BPE = 1, 2
_MODEL_TYPE, _BYTE_FALLBACK = 3, 35
_CHARS_MAP, _DUMMY_PREFIX, _EXTRA_BLANKS, _ESCAPE = 2, 3, 4, 5


def fields(data: bytes):
    """(field number, value) of a protobuf message; nested messages stay bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            value = number()
        else:
            size = {1: 8, 5: 4}.get(kind)
            size = number() if kind == 2 else size
            if size is None:
                raise ValueError(f"unknown wire type {kind}")
            value = data[at : at + size]
            at += size
        yield key >> 3, value


class PieceModel:
    """A parsed model file and the tokenizer rebuilt from it."""

    def __init__(self, data: bytes, threads: int = THREADS):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.pieces, trainer, normalizer = [], {}, {}
        for field, value in fields(data):
            if field == _PIECES:
                own = dict(fields(value))
                score = struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0]
                self.pieces.append((own.get(1, b"").decode(), score, own.get(3, _NORMAL)))
            elif field == _TRAINER:
                trainer = dict(fields(value))
            elif field == _NORMALIZER:
                normalizer = dict(fields(value))
        self.kind = trainer.get(_MODEL_TYPE, _UNIGRAM)
        self.byte_fallback = bool(trainer.get(_BYTE_FALLBACK, 0))
        self.prefix = bool(normalizer.get(_DUMMY_PREFIX, 1))
        self.squash = bool(normalizer.get(_EXTRA_BLANKS, 1))
        self.escape = bool(normalizer.get(_ESCAPE, 1))
        self.unknown = next(i for i, p in enumerate(self.pieces) if p[2] == _UNKNOWN)
        self.plain = self.prefix and self.escape and not self.squash and not normalizer.get(_CHARS_MAP)
        self._normalizer = self._build_normalizer(normalizer.get(_CHARS_MAP, b""))
        self.tokenizer = self._build_model()
        inner = re.compile(f"[^{MARK}]{MARK}")
        words = [p for p, _, kind in self.pieces if kind in (_NORMAL, _USER)]
        self.cuts = self.escape and not any(inner.search(p) for p in words)
        own_bytes = [
            bytes([int(p[3:5], 16)]) if kind == _BYTE else p.encode() for p, _, kind in self.pieces
        ]
        self._spelled = [
            b"" if kind == _CONTROL else b" \xe2\x81\x87 " if kind == _UNKNOWN else own
            for (_, _, kind), own in zip(self.pieces, own_bytes)
        ]
        self.known: dict[str, bytes] = {}

    def _build_normalizer(self, chars_map: bytes):
        from tokenizers import Regex, normalizers

        steps = [normalizers.Precompiled(chars_map)] if chars_map else []
        if self.squash:
            steps += [normalizers.Replace(Regex("\\A +"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.prefix:
            steps.append(normalizers.Prepend(" "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        if self.squash:  # markers of the text itself go as well
            steps.append(normalizers.Replace(Regex(f"{MARK if self.escape else ' '}+\\z"), ""))
        return normalizers.Sequence(steps)

    def _build_model(self):
        from tokenizers import AddedToken, Tokenizer, models

        if self.kind == _UNIGRAM:
            vocab = [(p, s) for p, s, _ in self.pieces]
            model = models.Unigram(vocab, self.unknown, self.byte_fallback)
        elif self.kind == _BPE:
            number = {p: i for i, (p, _, _) in enumerate(self.pieces)}
            usable = {p: s for p, s, kind in self.pieces if kind in (_NORMAL, _USER, _UNUSED)}
            merges = [
                (-score, len(p[:cut]), p[:cut], p[cut:])
                for p, score in usable.items()
                for cut in range(1, len(p))
                if p[:cut] in usable and p[cut:] in usable
            ]
            model = models.BPE(
                vocab=number,
                merges=[(a, b) for _, _, a, b in sorted(merges, key=lambda m: m[:2])],
                unk_token=self.pieces[self.unknown][0],
                fuse_unk=True,
                byte_fallback=self.byte_fallback,
            )
        else:
            raise ValueError(f"model type {self.kind} is neither unigram nor BPE")
        built = Tokenizer(model)
        built.add_tokens(
            [AddedToken(p, normalized=False) for p, _, kind in self.pieces if kind == _USER]
        )
        return built

    def normalize(self, text: str) -> str:
        return self._normalizer.normalize_str(text) if text else ""

    def _parts(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.cuts:
            return [text]
        if MARK * 2 in text:
            return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", text)
        first, *rest = text.split(MARK)
        return ([first] if first else []) + [MARK + part for part in rest]

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids (unsigned 32-bit, little-endian)."""
        if len(self.known) > ROOM:  # short parts come often
            self.known = {part: self.known[part] for part in sorted(self.known, key=len)[: ROOM // 2]}
        quick, split, unknown = self.plain and self.cuts, [], set()
        for text in texts:
            # single blanks: the words, each of which a marker precedes
            if quick and text and text[0] != " " and "  " not in text and MARK not in text:
                split.append(text.split(" "))
            else:
                split.append([p[1:] if p[:1] == MARK else "\ud800" + p for p in self._parts(self.normalize(text))])
            unknown.update(split[-1])
        unknown.difference_update(self.known)
        fresh = list(unknown)
        for at in range(0, len(fresh), 20_000):
            some = fresh[at : at + 20_000]
            parts = [p[1:] if p[:1] == "\ud800" else MARK + p for p in some]
            for key, found in zip(some, self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)):
                self.known[key] = array("I", found.ids).tobytes()
        known = self.known.__getitem__
        return [b"".join(map(known, p)) for p in split]

    def decode(self, ids) -> str:
        """The text of ids; control pieces are silent, the marker is a blank, the dummy prefix goes."""
        spelled = list(map(self._spelled.__getitem__, ids))
        if self.squash:  # each piece gives up a leading marker until one has text
            for at, piece in enumerate(spelled):
                spelled[at] = piece.removeprefix(MARK.encode())
                if spelled[at]:
                    break
        text = b"".join(spelled).decode("utf-8", "replace")
        text = text.replace(MARK, " ") if self.escape else text
        return text[1:] if self.prefix and not self.squash and text.startswith(" ") else text


_loaded: dict[str, tuple] = {}


def _backends(path: str):
    if path not in _loaded:
        import sentencepiece

        with open(path, "rb") as source:
            model = PieceModel(source.read())
        _loaded[path] = model, sentencepiece.SentencePieceProcessor(model_file=path)
    return _loaded[path]


def encode_documents(docs: DataFrame, model_path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, same (as the sentencepiece library), round_trip (decoded: the text), and ids."""
    ship_code(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids_crc32", "same", "round_trip", "ids"][: 6 if with_ids else 5]

    def encode(batches):
        model, other = _backends(model_path)
        for batch in batches:
            ids, texts, out = batch["doc_id"].tolist(), batch["text"].tolist(), []
            for a, b in chunks(texts):
                theirs = other.encode(texts[a:b], num_threads=1)
                for doc_id, text, raw, check in zip(ids[a:b], texts[a:b], model.encode(texts[a:b]), theirs):
                    same = array("I", check).tobytes() == raw
                    back = model.decode(check if same else array("I", raw)) == text
                    out.append((doc_id, len(raw) // 4, zlib.crc32(raw), same, back, raw)[: len(names)])
            frame = pd.DataFrame(out, columns=names)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    kinds = "doc_id bigint, n_tokens bigint, ids_crc32 bigint, same boolean, round_trip boolean"
    return documents(docs).mapInPandas(encode, kinds + (", ids binary" if with_ids else ""))


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text from doc_id, ids."""

    def decode(batches):
        model, _ = _backends(model_path)
        for batch in batches:
            texts = [model.decode(array("I", bytes(b or b""))) for b in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text": texts})

    return encoded.select("doc_id", "ids").mapInPandas(decode, "doc_id bigint, text string")
