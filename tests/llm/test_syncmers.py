"""Anchors, fingerprints and likeness against a brute-force version with the public xxhash."""

import random
import re
import struct

import pytest
import xxhash

from cardlake.llm import fingerprints


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def chained(values):
    """64-bit numbers hashed one after the other, the last hash as seed; it starts from 42."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=h)
    return signed(h)


def anchors(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]{1,16}", text or "")
    words = [signed(xxhash.xxh64_intdigest(t.encode(), seed=42)) for t in tokens]
    if len(words) < 5:
        return [(0, chained(words))] if words else []
    pairs = [chained(words[i : i + 2]) for i in range(len(words) - 1)]
    found = []
    for i in range(len(words) - 4):
        inner = pairs[i : i + 4]
        if min(inner) in (inner[0], inner[3]):
            found.append((i, chained([inner[0], inner[2], inner[3]])))
    return found


def sketch(text):
    return sorted({(a % (1 << 64)) >> 33 for _, a in anchors(text)})[:64]


def likeness(a, b):
    union = sorted({*a, *b})[:64]
    return sum(h in a and h in b for h in union) / len(union) if union else 1.0


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(8)
    words = [f"wörd{i}" for i in range(60)]
    some = [" ".join(rnd.choices(words, k=n)) for n in (1, 4, 5, 6, 40, 400, 7000)]
    return [None, "", " \t", *some, f"{some[4]} {some[3]}", some[5][:900], "y" * 200, "same " * 50, some[5]]


def test_anchors(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {}
    for r in fingerprints.anchors(docs).collect():
        got.setdefault(r.doc_id, []).append((r.position, r.anchor))
    for i, text in enumerate(texts):
        assert sorted(got.get(i, [])) == anchors(text)


def test_fingerprints_and_likeness(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in fingerprints.compare_with_next(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        text, following = text or "", texts[i - 1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        assert got[i].fingerprint == "".join(f"{h:08x}" for h in sketch(text))
        assert got[i].edited_fingerprint == "".join(f"{h:08x}" for h in sketch(edited))
        assert got[i].near_edited == pytest.approx(likeness(sketch(text), sketch(edited)))
        assert got[i].near_next == pytest.approx(likeness(sketch(text), sketch(following)))


def jaccard(a, b):
    a, b = ({(h % (1 << 64)) >> 33 for _, h in anchors(t)} for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_all_anchors_are_compared(spark, texts):
    """A difference that lies beyond the 64 smallest hashes shows in the likeness of the whole sets."""
    words = texts[9].split()
    base = sketch(texts[9])
    # one word more: the two long texts share their fingerprint, not their anchors
    close = next(t for w in range(1000) if sketch(t := " ".join([*words, f"new{w}"])) == base and jaccard(t, texts[9]) < 1)
    rows = [*texts, close, texts[9]]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in fingerprints.compare_with_next(docs).collect()}
    last = got[len(rows) - 1]
    assert last.near_next == 1.0 and 0 < last.all_next < 1
    for i, text in enumerate(rows):
        text, following = text or "", rows[i - 1] or ""
        cut = len(text) // 3
        assert got[i].n_anchors == len({(h % (1 << 64)) >> 33 for _, h in anchors(text)})
        assert got[i].all_edited == pytest.approx(jaccard(text, text[: len(text) - cut] + following[:cut]))
        assert got[i].all_next == pytest.approx(jaccard(text, following))


def test_texts_are_shuffled_once(spark, texts, monkeypatch):
    """Both joins of the texts use one shuffle: no column may stand in one of them alone."""
    docs = spark.createDataFrame(list(enumerate(texts)) * 2, "doc_id bigint, text string").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans, settle = [], fingerprints.settle

    def noted(df, label):
        plans.append((label, df._jdf.queryExecution()))
        return settle(df, label)

    monkeypatch.setattr(fingerprints, "settle", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert fingerprints.compare_with_next(docs).count() == 2 * len(texts)
        plan = dict(plans)["fingerprints"].optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    firsts = {re.sub(r"#\d+L?", "", line).strip(" :+-") for line in plan.splitlines() if "first(text" in line}
    assert len(firsts) == 1 and plan.count("first(text") == 2
