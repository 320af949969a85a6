"""The training-text operators against brute force, on rows with nulls, copies and clashing columns."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cardlake.llm import ann, common, fingerprints, lm, neardup, packing, quality, sharding, spiece, substrings, suffixes
from cardlake.llm.components import components

SCHEMA = "doc_id bigint, text string, source string, lang string, n_chars bigint, shard int, _id string"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def corpus():
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcdefgÉ", k=rnd.randint(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(rnd.choices(words, k=n))
    passage, base = text(70), text(200)
    texts = [None, "", " \n\t", "one", "One", "two words", "x" * 300, base, base, base.upper()]
    for _ in range(12):  # near copies
        changed = base.split(" ")
        for _ in range(rnd.randint(0, 9)):
            changed[rnd.randrange(200)] = rnd.choice(words)
        texts.append(" ".join(changed))
    texts += [text(30) + " " + passage + " " + text(20) for _ in range(5)]
    texts += [passage + " " + passage + " " + text(9), text(5000), base[:300] + "<|endoftext|>  " + base[300:]]
    rows = [(i * 3 % 97, t, "s", "en", len(t or ""), 7, "clash") for i, t in enumerate(texts)]
    rows.append(rows[8])  # a repeated row
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def unique(rows):
    return sorted({r[:2] for r in rows}, key=lambda r: r[0])


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_near_duplicates(docs, nothing):
    sets = {}
    for i, t in unique(corpus()):
        w = split_words(fold(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(corpus())
    for r in got:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), find(r.doc_id))
        assert r.kept == (r.doc_id == r.component_id)
    assert neardup.near_duplicates(nothing).count() == 0


def test_blocks_find_the_same_groups(docs, monkeypatch):
    whole = {(r.doc_id, r.component_id) for r in neardup.near_duplicates(docs).collect()}
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 4000)
    assert {(r.doc_id, r.component_id) for r in neardup.near_duplicates(docs).collect()} == whole


def test_rows_that_share_or_lack_a_doc_id(spark):
    rnd = random.Random(12)
    text = lambda: " ".join(f"w{rnd.randrange(9999)}" for _ in range(80))
    a, b, c, d = (text() for _ in range(4))
    rows = [
        (None, a), (None, b), (None, a), (None, c + " end"), (3, a + " end"), (4, b + " end"), (5, c),
        (7, d), (8, d + " end"), (8, text()), (9, text()), (9, text()), (20, d), (20, d), (None, ""), (None, None),
    ]
    rows = [(i, t, n) for n, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n int").repartition(5)
    want = Counter({(i, t) for i, t, n in rows if n not in (4, 5, 6, 8, 12, 13) and t})
    for percent in (80, 85):
        got = neardup.near_duplicates(docs, percent).collect()
        assert Counter((r.doc_id, r.component_id) for r in got) == Counter(
            (i, None if n in (4, 5, 6) else 7 if n in (8, 12, 13) else i) for i, t, n in rows
        )
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert Counter((r.doc_id, r.text) for r in kept if r.text) == want
    assert sum(not r.text for r in kept) == 2


def test_links_of_many_near_equal_sets_stay_small():
    """6,000 notices that differ in their last numbers: 18 million pairs were held at once."""
    common = " ".join(f"w{i}" for i in range(60))
    texts = [f"{common} n{i}" for i in range(6000)]
    sets = [neardup.shingles(t) for t in texts]
    sketches = np.stack([neardup.to_registers(neardup.smallest_hashes(s, 125)) for s in sets])
    sizes = np.array([len(s) for s in sets])
    for sides in (None, np.arange(6000) % 2):
        tracemalloc.start()
        links = neardup._links(list(range(6000)), sizes, sketches, sets, sides, 85)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        root = neardup._Forest(6000)
        for a, b in links:
            root.up[root.root(b)] = root.root(a)
        assert len(links) == 5999 and len({root.root(i) for i in range(6000)}) == 1
        assert peak < 250_000_000


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 50), (60, 61), (61, 60), (None, 3)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {(i, 0) for i in range(31)} | {(60, 60), (61, 60)}


def test_word_windows(docs, nothing):
    first = {}
    rows = unique(corpus())
    for i, t in rows:
        w = split_words(t)
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    want = {}
    for i, t in rows:
        w = split_words(t)
        gone = {j for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for j in range(k, k + 50)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = substrings.removed_words(docs).collect()
    assert len(got) == len(corpus()) and any(r.n_removed for r in got)
    assert all(tuple(r)[1:] == want[r.doc_id] for r in got)
    cut = substrings.remove_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert substrings.removed_words(nothing).count() == 0


@pytest.mark.parametrize("hot", [4096, 1])
def test_byte_windows(docs, nothing, hot, monkeypatch):
    monkeypatch.setattr(suffixes.repeated_windows, "__defaults__", (100, 40, hot))
    seen, want = set(), {}
    for i, t in unique(corpus()):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(raw[k : k + 100])
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        want[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    got = suffixes.remove_repeats(docs, with_bytes=False).collect()
    assert len(got) == len(corpus())
    assert all(tuple(r)[1:] == want[r.doc_id] for r in got)
    assert suffixes.remove_repeats(nothing).count() == 0


def test_hot_grams_reach_tasks_in_bounded_groups(spark, monkeypatch):
    """300 documents share a passage and a footer under 100 bytes, all with other text around them."""
    rnd = random.Random(6)
    text = lambda n: "".join(rnd.choices("abcdefghij ", k=n))
    passage, footer = text(250), text(85)
    rows = [(i, text(rnd.randint(60, 150)) + passage + text(rnd.randint(60, 150)) + footer + text(90)) for i in range(300)]
    inner = suffixes.later_windows

    def bounded(payloads, *args):
        assert len(payloads) <= 100
        return inner(payloads, *args)

    monkeypatch.setattr(suffixes, "later_windows", bounded)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(suffixes.repeated_windows, "__defaults__", (100, 40, 20))
    seen, want = set(), {}
    for i, t in rows:
        raw = t.encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(raw[k : k + 100])
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        want[i] = (len(raw), sum(gone), hashlib.sha256(kept).hexdigest())
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = suffixes.remove_repeats(docs, with_bytes=False).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in got} == want


def test_merged_transforms():
    rnd = random.Random(2)
    for _ in range(150):
        unit = rnd.choice([1, 2, 5])
        strings = [bytes(rnd.choices(b"ab\0", k=rnd.randint(1, 30))) for _ in range(rnd.randint(1, 8))]
        depth = unit * rnd.randint(1, 6)
        place, start = suffixes.intervals(strings, depth, rnd.choice([5, 20, 1000]), unit)
        whole, begin = defaultdict(set), 0
        for s in strings:
            for k in range(len(s) - depth + 1):
                whole[s[k : k + depth]].add(begin + k)
            begin += len(s)
        found = defaultdict(set)
        for group, p in zip(np.cumsum(start), place.tolist()):
            found[group].add(p)
        assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in whole.values() if len(v) > 1)


def test_packing(docs, nothing):
    tokenizer = Tokenizer.from_file(BPE)
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in unique(corpus())}
    got = packing.pack_documents(docs, BPE).collect()
    for r in got:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert r.length <= 2048 and zlib.crc32(part.tobytes()) == r.ids_crc32
    assert sum(r.length for r in got) == sum(len(ids[r[0]]) for r in corpus())
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(nothing, BPE).count() == 0


def test_minimum_slack():
    rnd = random.Random(3)
    counts = Counter(rnd.randint(1, 900) for _ in range(3000))
    bins = packing.minimum_slack(dict(counts))
    used = Counter()
    for times, taken in bins:
        assert sum(k * n for k, n in taken.items()) <= 2048
        used.update({k: times * n for k, n in taken.items()})
    assert used == counts
    assert sum(t for t, _ in bins) <= math.ceil(sum(k * n for k, n in counts.items()) / 2048) * 1.01 + 1


def test_sentencepiece(docs, nothing):
    got = spiece.encode_documents(docs, PIECES)
    rows = got.collect()
    assert all(r.same and r.round_trip for r in rows)
    texts = dict(unique(corpus()))
    assert all(r.text == (texts[r.doc_id] or "") for r in spiece.decode_documents(got, PIECES).collect())
    assert spiece.encode_documents(nothing, PIECES).count() == 0


@pytest.mark.parametrize("most", [lm.RANGE, 1])
def test_kneser_ney(docs, nothing, monkeypatch, most):
    monkeypatch.setattr(lm, "RANGE", most)  # one range of words, or one for each bucket
    monkeypatch.setattr(lm, "BUCKET", lm.BUCKET if most > 1 else 500)
    texts = [(i, split_words(fold(t)) + ["</>"]) for i, t, *_ in corpus()]
    learn = [t for i, t in texts if zlib.crc32(str(i).encode()) % 10]
    one = Counter(w for t in learn for w in t)
    two = Counter(p for t in learn for p in zip(["<>", *t[:-1]], t))
    kinds, total = Counter(v for _, v in two), Counter()
    rest = defaultdict(lambda: [0, 0, 0, 0])
    for (u, _), c in two.items():
        total[u] += c
        rest[u][min(c, 3)] += 1
    cut = lm._discounts([sum(c == n for c in two.values()) for n in (1, 2, 3, 4)])
    low = lm._discounts([sum(c == n for c in kinds.values()) for n in (1, 2, 3, 4)])
    shared = sum(low[min(c, 3)] for c in kinds.values()) / len(two)

    def word(v):
        return max(kinds[v] - low[min(kinds[v], 3)], 0) / len(two) + shared / (len(one) + 1)

    def p(u, v):
        if not total[u]:
            return word(v)
        c = two[u, v]
        back = sum(cut[i] * rest[u][i] for i in (1, 2, 3)) / total[u]
        return max(c - cut[min(c, 3)], 0) / total[u] + back * word(v)

    assert abs(sum(p("<>", v) for v in one) + p("<>", "never seen") - 1) < 1e-9
    want = {i: sum(math.log10(p(u, v)) for u, v in zip(["<>", *t[:-1]], t)) for i, t in texts}
    got = lm.score_documents(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.train_tokens == sum(one.values()) and abs(r.score - want[r.doc_id]) < 1e-6 * max(1, -r.score)
    assert lm.score_documents(nothing).count() == 0


def test_ranges_of_words():
    offsets = np.array([0, 3, 3, 10, 30])
    weights = np.array([5, 0, lm.RANGE, 7])
    assert lm.range_edges(offsets, weights).tolist() == [0, 3, 10, 30]
    assert lm.range_edges(offsets, weights * 0).tolist() == [0, 30]
    assert lm._smallest(np.array([1, 1 << 32])).tolist() == [1, 1 << 32]
    assert lm._smallest(np.array([7])).dtype == np.uint32


def test_nearest(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rnd.normal(size=8)], "x") for i in range(400)]
    rows += [(400 + i, rows[0][1], "x") for i in range(300)]  # a hot vector
    rows += [(900, None, "x"), (901, [0.0] * 8, "x"), (902, [1.0, None] * 4, "x"), (903, [float("nan")] * 8, "x"), rows[3]]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string")
    got = ann.nearest(table, lambda i: i % 50 == 0).collect()
    good = {i: np.array(v) for i, v, _ in rows if i < 900}
    hits = 0
    for q in range(0, 700, 50):
        near = sorted((-(good[q] @ v) / math.sqrt((good[q] @ good[q]) * (v @ v)), i) for i, v in good.items() if i != q)
        exact = sorted((round(s, 12), i) for s, i in near)[:5]
        mine = sorted((r.rank, r.vec_id) for r in got if r.query_id == q)
        assert [k for k, _ in mine] == [1, 2, 3, 4, 5]
        hits += len({i for _, i in mine} & {i for _, i in exact})
    assert hits >= 0.9 * 5 * 14
    assert ann.nearest(table.limit(0), lambda i: i % 50 == 0).count() == 0


def test_shards(docs, nothing):
    got = sharding.shard_rows(docs).collect()
    size = {i: len((t or "").encode()) + 1 for i, t in unique(corpus())}
    text = {i: t or "" for i, t in unique(corpus())}
    slots, homes, load = defaultdict(list), defaultdict(set), Counter()
    for r in got:
        assert r["size"] == size[r.doc_id] and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        slots[r.shard].append(r.slot)
        homes[text[r.doc_id]].add(r.shard)
        load[r.shard] += r["size"]
    assert len(got) == len(corpus()) and all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    assert sharding.shard_rows(nothing).count() == 0


def test_smallest_capacity(spark):
    rnd = random.Random(6)
    for _ in range(4):
        sizes = [rnd.randint(1, 60) for _ in range(40)]
        ends = np.cumsum(sizes).tolist()
        table = spark.createDataFrame([(e,) for e in ends], "e bigint")
        got = sharding.smallest_capacity(table, "e", ends[-1], max(sizes), 5)[0]

        def needed(capacity):
            shards, room = 1, capacity
            for s in sizes:
                if s > room:
                    shards, room = shards + 1, capacity
                room -= s
            return shards

        assert got == min(c for c in range(max(sizes), ends[-1] + 1) if needed(c) <= 5)


def test_fingerprints(docs, nothing):
    got = fingerprints.compare_with_next(docs).collect()
    rows = sorted(unique(corpus()), key=lambda r: -r[0])
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in corpus())
    by = {r.doc_id: r for r in got}
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 3
        edited = t[: len(t) - n] + nxt[:n]
        assert by[i].n_chars == len(t)
        assert by[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= by[i].near_edited <= 1 and 0 <= by[i].near_next <= 1
    same = defaultdict(set)
    for i, t in rows:
        same[t or ""].add(by[i].fingerprint)
    assert all(len(s) == 1 for s in same.values())
    places = fingerprints.anchors(docs).filter("doc_id = 21").collect()
    assert places and all(r.position >= 0 for r in places)
    assert fingerprints.compare_with_next(nothing).count() == 0


def test_quality(spark, nothing):
    rnd = random.Random(8)
    good = lambda: " ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(2, 9))) for _ in range(80)) + "."
    rows = [(i, good() if i % 2 else "buy now | " * rnd.randint(10, 40)) for i in range(400)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(400)] + [(5, None, 0), (7, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    got = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    assert len(got) == 402 and all(0 <= r.score <= 1 for r in got.values())
    assert sum(got[i].predicted == i % 2 for i in range(400) if got[i].held_out) >= 0.95 * sum(
        got[i].held_out for i in range(400)
    )
    assert {r.score for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_documents(nothing, labels).count() == 0
    assert list(quality.pool_violators(np.array([1.0, 0.0, 2.0]), np.ones(3))) == [0.5, 0.5, 2.0]


def test_pipeline(spark, docs, tmp_path):
    path = str(tmp_path)
    docs.select("doc_id", "text", "source", "lang", "n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    table = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, table, path)
        assert after.columns == table.columns, name
        assert after.count() <= table.count()
    got = corpus_pipeline.run(spark, path)
    groups = neardup.near_duplicates(docs, percent=80).filter("kept").select("doc_id").distinct().collect()
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in groups}


def twisted():
    """Two different words of 1,024 letters that sums of powers modulo 2**64 can't tell apart."""
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    return a, b


def test_words_that_look_alike_to_sums_of_powers(spark):
    a, b = twisted()
    schema = "doc_id bigint, text string"
    got = neardup.near_duplicates(spark.createDataFrame([(1, a), (2, b), (3, a)], schema)).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1}
    rest = " ".join(f"w{i}" for i in range(49))
    docs = spark.createDataFrame([(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, f"{a} {rest}")], schema)
    assert {r.doc_id: r.n_removed for r in substrings.removed_words(docs).collect()} == {1: 0, 2: 0, 3: 50}
    train = [i for i in range(40) if zlib.crc32(str(i).encode()) % 10][:2]
    docs = spark.createDataFrame([(train[0], a), (train[1], b)], schema)
    base = sum(math.log10((c + 0.1) / (4 + 0.1 * 4)) for c in (1, 2))
    for r in lm.score_documents(docs).collect():
        assert abs(r.base_score - base) < 1e-9


def test_hashes_tell_strings_apart():
    rnd = random.Random(9)
    strings = {bytes(rnd.choices(b"ab\x00", k=rnd.randint(0, 90))) for _ in range(20_000)}
    strings |= {s + b"\x00" for s in list(strings)[:500]} | {t.encode() for t in twisted()}
    strings = sorted(strings)
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    ends = np.cumsum([len(s) for s in strings])
    starts = ends - [len(s) for s in strings]
    assert len(set(common.byte_hashes(data, starts, ends).tolist())) == len(strings)
    turned = np.frombuffer(b"x" + b"".join(reversed(strings)), dtype=np.uint8)
    back = 1 + np.cumsum([0] + [len(s) for s in reversed(strings)])
    other = common.byte_hashes(turned, back[:-1], back[1:])[::-1]
    assert (other == common.byte_hashes(data, starts, ends)).all()
