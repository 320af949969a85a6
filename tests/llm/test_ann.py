"""Nearest neighbours against brute force: one direction many times, near copies, ties, lengths, several shards."""

import numpy as np
import pytest

from cardlake.llm import ann

_shard_size = ann.shard_size
SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, top=5):
    """Nearest of every fifth id: cosines of scaled vectors, ties (12 decimals) to smaller ids."""
    ids = np.array([i for i, _ in rows])
    x = np.array([np.array(v) / np.abs(v).max() for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = {}
    for at in np.flatnonzero(ids % 5 == 0):
        near = np.round(x @ x[at], 12)
        order = [k for k in np.lexsort((ids, -near)) if ids[k] != ids[at]][:top]
        want[int(ids[at])] = [(int(ids[k]), float(near[k])) for k in order]
    return want


def check(spark, rows, by_id=True):
    """Recall at 5 over all queries, by id or (where copies differ less than doubles tell) by score."""
    table = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], SCHEMA).repartition(3)
    got = {}
    for r in ann.nearest(table, lambda i: i % 5 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    want, hits = brute(rows), 0
    assert set(got) == set(want)
    for query, near in want.items():
        assert sorted(got[query]) == list(range(1, len(near) + 1))
        mine = [got[query][k] for k in sorted(got[query])]
        assert len({i for i, _ in mine}) == len(mine)
        hits += (
            len({i for i, _ in mine} & {i for i, _ in near})
            if by_id
            else sum(score >= near[-1][1] - 1e-9 for _, score in mine)
        )
    return hits / sum(map(len, want.values()))


@pytest.fixture(params=[4096, 150], ids=["one shard", "several shards"], autouse=True)
def shard(request, monkeypatch):
    monkeypatch.setattr(ann, "shard_size", lambda nodes, dimension: request.param)


def test_multiples_of_one_vector(spark):
    rnd = np.random.default_rng(1)
    vector = rnd.normal(size=16)
    rows = [(i, vector * (i + 1)) for i in range(300)] + [(300 + i, rnd.normal(size=16)) for i in range(300)]
    assert check(spark, rows) >= 0.99
    few = [(i, vector * (i + 3) / 7) for i in range(21)] + [(100 + i, rnd.normal(size=16)) for i in range(30)]
    assert check(spark, few) == 1


@pytest.mark.parametrize("noise", [1e-8, 1e-4, 1e-2])
def test_near_copies(spark, noise):
    rnd = np.random.default_rng(2)
    vector = rnd.normal(size=16)
    rows = [(i, vector + noise * rnd.normal(size=16)) for i in range(400)]
    rows += [(400 + i, rnd.normal(size=16)) for i in range(400)]
    assert check(spark, rows, by_id=noise > 1e-8) >= 0.95


def test_ties_go_to_the_smaller_id(spark):
    rnd = np.random.default_rng(3)
    rows = []
    for i in range(40):  # signed axes: many equal scores at the cut
        v = np.zeros(8)
        v[i % 8] = (-1) ** (i // 8) * (i + 1)
        rows.append((i, v))
    rows += [(100 + i, rnd.choice([-1.0, 1.0], size=8)) for i in range(60)]
    assert check(spark, rows) == 1


def test_very_long_and_very_short_vectors(spark):
    rnd = np.random.default_rng(4)
    lengths = [1e160, 1e-170, 1.0, 1e300, 5e-300]
    rows = [(i, rnd.normal(size=8) * lengths[i % 7 % 5]) for i in range(200)]
    assert check(spark, rows) >= 0.95


def test_dimensions_never_meet(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rnd.normal(size=3 + i % 2)]) for i in range(60)] + [(61, [1.0, 2.0])]
    got = ann.nearest(spark.createDataFrame(rows, SCHEMA), lambda i: i % 5 == 0).collect()
    assert len(got) == 12 * 5 and all(r.query_id % 2 == r.vec_id % 2 for r in got)


def test_every_lead_is_reachable():
    rnd = np.random.default_rng(6)
    middle = rnd.normal(size=16)
    x = np.concatenate([middle + 1e-2 * rnd.normal(size=(700, 16)), rnd.normal(size=(500, 16)), np.tile(middle, (9, 1))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    edges, entry, lead = ann.build_graph(x)
    reached = np.zeros(len(x), dtype=bool)
    ann._reached(edges, reached, np.array([entry]))
    leads = lead == np.arange(len(x))
    assert (reached == leads).all() and leads.sum() == 1201 and (lead[lead] == lead).all()


def test_shards_grow_slower_than_the_table():
    size = _shard_size
    assert size(1000, 64) == ann.SHARD and size(10**8, 64) == 40_000
    assert size(10**12, 1024) == ann.SHARD_BYTES // 8192
