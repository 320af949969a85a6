"""SentencePiece models written by hand, field by field, against the sentencepiece library."""

import random
import struct
from array import array

import public_tokenizers
import pytest
import sentencepiece

from cardlake.llm import spiece

SCHEMA = "doc_id bigint, text string, ids string"


def field(number, value):
    def varint(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes(out + bytes([n]))

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram(fallback, prefix, squash, user=()):
    """A model with single letters, marked beginnings and random longer pieces, each with its own score."""
    rnd = random.Random(3)
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(u, 0.0, 4) for u in user]
    if fallback:
        pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    words = {"▁", *"abcde", *("▁" + c for c in "abc")}
    while len(words) < 60:
        words.add(("▁" if rnd.random() < 0.4 else "") + "".join(rnd.choices("abcdé", k=rnd.randint(2, 4))))
    # scores that no two ways to cut a text can share
    pieces += [(w, -2.0 - rnd.random() * 9, 1) for w in sorted(words)]
    body = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    trainer = field(3, 1) + field(4, len(pieces)) + field(35, int(fallback))
    normalizer = field(1, b"identity") + field(3, int(prefix)) + field(4, int(squash)) + field(5, 1)
    return body + field(2, trainer) + field(3, normalizer)


def texts():
    rnd = random.Random(5)
    found = ["", " ", "  ", "a", " a", "a ", "a  b", "  a   b  ", "zebra", "日本 a", "a▁b", "▁", "a ▁", "▁ a", "a\nb\tc", "\na \n", "\u00a0a\u3000", "é" * 9]
    found += ["".join(rnd.choices("abcdeé  z", k=rnd.randint(1, 60))) for _ in range(400)]
    return found + ["".join(rnd.choices("abcde ", k=20_000))]


@pytest.mark.parametrize("fallback", [False, True])
@pytest.mark.parametrize("prefix", [False, True])
@pytest.mark.parametrize("squash", [False, True])
def test_unigram_model(fallback, prefix, squash):
    data = unigram(fallback, prefix, squash)
    model, other = spiece.PieceModel(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text, raw in zip(texts(), model.encode(texts())):
        ids = array("I", raw).tolist()
        assert ids == other.encode(text), text
        assert model.decode(ids) == other.decode(ids), text


def test_scores_decide():
    data = unigram(True, True, False)
    model = spiece.PieceModel(data)
    score = {p: s for p, s, kind in model.pieces if kind == 1}

    def best(text):  # the best total over all ways to cut
        found = [0.0] + [-1e9] * len(text)
        for end in range(1, len(text) + 1):
            found[end] = max(found[at] + score.get(text[at:end], -1e9) for at in range(end))
        return found[-1]

    rnd = random.Random(8)
    for _ in range(100):
        text = "".join(rnd.choices("abcde ", k=rnd.randint(1, 25)))
        ids = array("I", model.encode([text])[0])
        assert abs(sum(model.pieces[i][1] for i in ids) - best("▁" + text.replace(" ", "▁"))) < 1e-4


def test_round_trip_is_that_of_the_text(spark):
    rows = [(i, t, "clash") for i, t in enumerate([*texts(), None])] + [(1, " ", "clash")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = spiece.encode_documents(docs, path).collect()
    other, given = sentencepiece.SentencePieceProcessor(model_file=path), {i: t or "" for i, t, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        ids = other.encode(given[r.doc_id])
        assert r.same and array("I", bytes(r.ids)).tolist() == ids
        assert r.round_trip == (other.decode(ids) == given[r.doc_id]), given[r.doc_id]
    assert [r.round_trip for r in got if given[r.doc_id] in ("a▁b", "a  b")].count(False) == 1
