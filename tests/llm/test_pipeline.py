"""The corpus pipeline on planted rows, each stage against a brute-force version of its own."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from cardlake.llm.common import settle


def planted():
    """(doc_id, text, is good); documents to reject, copies, near copies, shared passages, a long text."""
    rnd = random.Random(21)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rnd.choices(words, k=n))
    good = [text(rnd.randint(60, 160)) + "." for _ in range(260)]
    base, passage = text(200), text(64)
    good += [base + "."] * 3
    for changes in (1, 3, 6, 60):
        changed = base.split(" ")
        for at in rnd.sample(range(200), changes):
            changed[at] = rnd.choice(words)
        good.append(" ".join(changed) + ".")
    good += [f"{text(60)}\n{passage}  {text(50)}." for _ in range(5)]
    good += [text(3000) + "."]
    bad = ["buy now | " * rnd.randint(10, 60) for _ in range(240)]
    rows = [(t, True) for t in good] + [(t, False) for t in bad]
    rnd.shuffle(rows)
    return [(i * 7 % 1009, t, ok) for i, (t, ok) in enumerate(rows)]


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def first_of_groups(rows):
    """The smallest doc_id of each group that likeness 0.8 of five-word shingles links."""
    sets = {}
    for i, t in rows:
        w = split_words(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i for i in ids if find(i) == i}


def cut(rows):
    """Texts without the words of 50-word windows that a smaller doc_id has as well."""
    first, out = {}, {}
    split = {i: split_words(t) for i, t in rows}
    for i in sorted(split):
        for k in range(len(split[i]) - 49):
            first.setdefault(tuple(split[i][k : k + 50]), i)
    for i, t in rows:
        gone = set()
        for k in range(len(split[i]) - 49):
            if first[tuple(split[i][k : k + 50])] < i:
                gone.update(range(k, k + 50))
        out[i] = " ".join(w for k, w in enumerate(split[i]) if k not in gone) if gone else t
    return out


def test_every_stage_against_brute_force(spark, tmp_path):
    rows, path = planted(), str(tmp_path)
    table = [(i, t, "s", "en", len(t)) for i, t, _ in rows]
    schema = "doc_id bigint, text string, source string, lang string, n_chars bigint"
    spark.createDataFrame(table, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(ok), 0) for i, _, ok in rows]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")

    docs = spark.read.parquet(f"{path}/documents.parquet")
    names, after = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, path), f"test_{name}")
        after.append(docs)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "substrings", "packing"]
    assert all(d.columns == names for d in after[:3])
    given = {i: t for i, t, _ in rows}

    left = {r.doc_id: r.text for r in after[0].collect()}
    assert left == {i: t for i, t, ok in rows if ok}  # both labels: what is bad goes, and nothing else

    kept = first_of_groups(left.items())
    left = {r.doc_id: r.text for r in after[1].collect()}
    assert left == {i: given[i] for i in kept} and 3 <= 273 - len(left) <= 6

    want = cut(left.items())
    rows_left = after[2].collect()
    assert {r.doc_id: r.text for r in rows_left} == want and len(rows_left) == len(want)
    assert sum(want[i] != t for i, t in left.items()) >= 4  # four of five that share the passage, and what shares others
    assert all(r.n_chars == len(r.text) for r in rows_left)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in want.items()}
    check_pieces(after[3].collect(), ids)
    check_pieces(corpus_pipeline.run(spark, path).collect(), ids)


def check_pieces(pieces, ids):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert 0 < r.length == len(part) <= 2048 and zlib.crc32(part.tobytes()) == r.ids_crc32
        by_doc[r.doc_id].append((r.piece, r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for i, parts in by_doc.items():
        at = 0
        for k, (piece, start, length) in enumerate(sorted(parts)):
            assert (piece, start) == (k, at)
            at += length
        assert at == len(ids[i]) and len(parts) == -(-len(ids[i]) // 2048)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(map(len, ids.values())) // 2048)
    assert len(by_sequence) <= least + 1
