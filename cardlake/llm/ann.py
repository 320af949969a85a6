"""Approximate nearest neighbours on robust-pruned directed graphs, one for each shard.

Vectors are dealt to shards of bounded size by a hash; equal vectors are one node that remembers its
smallest ids, so a vector that a third of all rows share costs no more than any other. In a shard,
nodes join the graph in batches of doubling size: a greedy beam search on the graph so far proposes
neighbours, and relaxed distance pruning keeps those that no kept neighbour makes redundant; reverse
edges are pruned alike. A node whose direction the graph already holds (multiples, copies with noise too
small for distances to tell) becomes a follower of that lead: pruning would drop all but one of them, so
a search that finds the lead scores its followers too. Leads that no path from the entry reaches are
linked from their nearest reached lead. The index (vectors and edges) is a table; queries are searched in
every shard by beam search, a block of them at a time, and the best of all shards are ranked by the cosine.
Shards grow with the root of the table up to a bound in bytes, so that their number grows more slowly.

Cases: vectors that are null, zero, empty or hold a null or non-finite component take no part, however
short or long the others are; vectors of different dimension never meet; rows that repeat id and vector
count once; scores equal to 12 decimals are ties and go to the smaller vec_id; fewer candidates than asked
are all returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.common import settle, ship_code

SHARD = 4096  # nodes at least
SHARD_BYTES = 128 << 20  # of vectors at most
QUERY_BLOCK = 1 << 16
SPARE = 4  # links beside the degree that keep leads reachable
SAME = 1e-10  # squared distance of one direction
DEGREE = 32
BUILD_BEAM = 64
BEAM = 96
RELAX = 1.2
BATCH = 512
INDEX = "_d int, _shard int, _node int, _lead int, _ids array<bigint>, _vector binary, _edges binary"


def usable(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """_id, _e (doubles): the rows that take part, repeated rows once."""
    e = F.col(vector_column).cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    nonzero = F.exists(e, lambda x: x != 0)
    return (
        table.select(F.col(id_column).cast("bigint").alias("_id"), e.alias("_e"))
        .filter(F.col("_id").isNotNull() & F.col("_e").isNotNull())
        .filter(F.coalesce(finite, F.lit(False)) & nonzero)
        .distinct()
    )


def beam_search(x, edges, entry, queries, beam, keep_visited=False):
    """Nearest nodes found for each query, nearest first: ids and squared distances, -1 and inf where none.

    x: unit vectors; edges: (n, degree) node numbers, -1 for none. With ``keep_visited`` the nodes
    that were expanded come along.
    """
    q, n = len(queries), len(x)
    ids = np.full((q, beam), -1, dtype=np.int32)
    far = np.full((q, beam), np.inf)
    done = np.zeros((q, beam), dtype=bool)
    seen = np.zeros((q, n), dtype=bool)
    ids[:, 0] = entry
    far[:, 0] = 2 - 2 * queries @ x[entry]
    seen[:, entry] = True
    visited = []
    active = np.arange(q)
    while len(active):
        open_far = np.where(done[active] | (ids[active] < 0), np.inf, far[active])
        best = open_far.argmin(axis=1)
        going = np.isfinite(open_far[np.arange(len(active)), best])
        active, best = active[going], best[going]
        if not len(active):
            break
        done[active, best] = True
        node = ids[active, best]
        if keep_visited:
            at = np.full(q, -1, dtype=np.int32)
            at[active] = node
            visited.append(at)
        near = edges[node]
        fresh = (near >= 0) & ~seen[active[:, None], near]
        rows, columns = np.nonzero(fresh)
        seen[active[rows], near[rows, columns]] = True
        distance = np.where(fresh, 2 - 2 * np.einsum("ard,ad->ar", x[near], queries[active]), np.inf)
        all_far = np.concatenate([far[active], distance], axis=1)
        all_ids = np.concatenate([ids[active], np.where(fresh, near, -1)], axis=1)
        all_done = np.concatenate([done[active], np.zeros(near.shape, dtype=bool)], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        far[active] = np.take_along_axis(all_far, order, axis=1)
        ids[active] = np.take_along_axis(all_ids, order, axis=1)
        done[active] = np.take_along_axis(all_done, order, axis=1)
    ids[~np.isfinite(far)] = -1
    if keep_visited:
        return ids, far, np.stack(visited, axis=1) if visited else ids[:, :0]
    return ids, far


def robust_prune(x, points, candidates, degree, relax):
    """For each point the diverse nearest of its candidates (rows of node numbers, -1 for none)."""
    out = np.full((len(points), degree), -1, dtype=np.int32)
    candidates = np.where(candidates == points[:, None], -1, candidates)
    order = np.sort(candidates, axis=1)
    order[:, 1:][order[:, 1:] == order[:, :-1]] = -1  # repeated ones once
    candidates = order
    vectors = x[candidates]
    far = np.where(candidates < 0, np.inf, 2 - 2 * np.einsum("bcd,bd->bc", vectors, x[points]))
    alive, rows = far.copy(), np.arange(len(points))
    for k in range(degree):
        best = alive.argmin(axis=1)
        found = np.isfinite(alive[rows, best])
        if not found.any():
            break
        out[:, k] = np.where(found, candidates[rows, best], -1)
        between = 2 - 2 * np.einsum("bcd,bd->bc", vectors, vectors[rows, best])
        alive[(relax * relax * between <= far) & found[:, None]] = np.inf
        alive[rows, best] = np.inf
    return out


def _followers(x, batch, lead):
    """Point nodes of the batch at an earlier one of the same direction; the rest are leads."""
    close = np.tril(2 - 2 * x[batch] @ x[batch].T <= SAME, -1)
    for i in np.flatnonzero(close.any(axis=1)):
        leads = [j for j in np.flatnonzero(close[i]) if lead[batch[j]] == batch[j]]
        if leads:
            lead[batch[i]] = batch[leads[0]]
    return batch[lead[batch] == batch]


def _reached(edges, reached, frontier):
    """Mark all nodes that paths from the frontier reach."""
    while len(frontier):
        reached[frontier] = True
        near = np.unique(edges[frontier])
        near = near[near >= 0]
        frontier = near[~reached[near]]


def keep_reachable(x, edges, entry, nodes):
    """Links for each node (up to ``SPARE``) that make all of ``nodes`` reachable from the entry."""
    spare = np.full((len(x), SPARE), -1, dtype=np.int32)
    used = np.zeros(len(x), dtype=np.int64)
    reached = np.zeros(len(x), dtype=bool)
    _reached(edges, reached, np.array([entry]))
    while True:
        lost = nodes[~reached[nodes]]
        if not len(lost):
            return spare
        homes = nodes[reached[nodes] & (used[nodes] < SPARE)]
        home, far = np.empty(len(lost), dtype=np.int64), np.empty(len(lost))
        for at in range(0, len(lost), 256):
            dots = x[lost[at : at + 256]] @ x[homes].T
            best = dots.argmax(axis=1)
            home[at : at + 256], far[at : at + 256] = homes[best], -dots[np.arange(len(best)), best]
        for i in np.argsort(far, kind="stable"):
            if used[home[i]] < SPARE and not reached[lost[i]]:
                spare[home[i], used[home[i]]] = lost[i]
                used[home[i]] += 1
                _reached(edges, reached, lost[i : i + 1])


def build_graph(x: np.ndarray, degree=DEGREE, beam=BUILD_BEAM, relax=RELAX, seed=3):
    """Edges of the graph over unit vectors, its entry (nearest to the middle) and the lead of each node."""
    n = len(x)
    edges = np.full((n, degree), -1, dtype=np.int32)
    lead = np.arange(n)
    entry = int((x @ x.mean(axis=0)).argmax())
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    at, size = 1, 1
    while at < n:
        batch = order[at : at + size]
        at += len(batch)
        size = min(2 * size, BATCH)
        place = {}
        for part in np.array_split(batch, -(-len(batch) // 256)):
            ids, far, visited = beam_search(x, edges, entry, x[part], beam, keep_visited=True)
            same = far[:, 0] <= SAME
            lead[part[same]] = ids[same, 0]
            place |= {int(v): row for v, row in zip(part, np.concatenate([ids, visited], axis=1))}
        batch = _followers(x, batch[lead[batch] == batch], lead)
        if not len(batch):
            continue
        widest = max(len(place[int(v)]) for v in batch)
        proposed = np.full((len(batch), widest), -1, dtype=np.int32)
        for row, v in enumerate(batch):
            proposed[row, : len(place[int(v)])] = place[int(v)]
        for rows in np.array_split(np.arange(len(batch)), -(-len(batch) // 256)):
            edges[batch[rows]] = robust_prune(x, batch[rows], proposed[rows], degree, relax)
        source = np.repeat(batch, degree)
        target = edges[batch].ravel()
        real = target >= 0
        source, target = source[real], target[real]
        nearest = np.lexsort((2 - 2 * np.einsum("ij,ij->i", x[source], x[target]), target))
        source, target = source[nearest], target[nearest]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for group in np.array_split(np.arange(len(nodes)), -(-len(nodes) // 256)):
            most = min(2 * degree, int(count[group].max(initial=0)))
            take = first[group][:, None] + np.arange(most)[None, :]
            incoming = np.where(
                np.arange(most)[None, :] < count[group][:, None],
                source[np.minimum(take, len(source) - 1)], -1,
            )
            mine = nodes[group]
            edges[mine] = robust_prune(x, mine, np.concatenate([edges[mine], incoming], axis=1), degree, relax)
    leads = np.flatnonzero(lead == np.arange(n))
    return np.concatenate([edges, keep_reachable(x, edges, entry, leads)], axis=1), entry, lead


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, so that squares neither over- nor underflow."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = _scaled(vectors)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def shard_size(nodes: int, dimension: int) -> int:
    """Nodes of a shard: four roots of the table, between ``SHARD`` and ``SHARD_BYTES`` of vectors."""
    most = max(1, SHARD_BYTES // (8 * max(1, dimension)))
    return min(most, max(SHARD, 4 * math.isqrt(nodes)))


def build_index(vectors: DataFrame, remember: int) -> DataFrame:
    """The index table over _id, _e: each node with its ``remember`` smallest ids, vector, lead and edges.

    Node 0 of a shard is the entry; leads come before their followers.
    """
    smallest = Window.partitionBy("_e").orderBy("_id")
    nodes = (
        vectors.withColumn("_place", F.row_number().over(smallest))
        .filter(F.col("_place") <= remember)
        .groupBy("_e")
        .agg(F.sort_array(F.collect_list("_id")).alias("_ids"))
    )
    nodes = settle(nodes.withColumn("_d", F.size("_e")), "ann_nodes")
    count, dimension = nodes.agg(F.count("*"), F.coalesce(F.max("_d"), F.lit(1))).first()
    shards = max(1, math.ceil(count / shard_size(count, dimension)))
    nodes = nodes.withColumn("_s", F.pmod(F.xxhash64("_e"), F.lit(shards)).cast("int"))

    def graph(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_ids", key=lambda c: c.map(lambda v: v[0])).reset_index(drop=True)
        vectors = np.stack(group["_e"].to_numpy()).astype(np.float64)
        edges, entry, lead = build_graph(_unit(vectors))
        numbers = np.arange(len(group), dtype=np.int32)
        new = np.lexsort((numbers, numbers != entry, lead != numbers))
        place = np.empty(len(group), dtype=np.int32)
        place[new] = numbers
        edges = np.where(edges >= 0, place[edges], -1)[new].astype(np.int32)
        return pd.DataFrame(
            {
                "_d": group["_d"].to_numpy(dtype=np.int32),
                "_shard": group["_s"].to_numpy(dtype=np.int32),
                "_node": numbers,
                "_lead": place[lead[new]],
                "_ids": [list(map(int, group["_ids"].iloc[i])) for i in new],
                "_vector": [vectors[i].tobytes() for i in new],
                "_edges": [e.tobytes() for e in edges],
            }
        )

    return settle(nodes.groupBy("_d", "_s").applyInPandas(graph, INDEX), "ann_index")


def search(index: DataFrame, queries: DataFrame, top: int, beam: int = BEAM) -> DataFrame:
    """_query, _id, _score, _near: up to ``top`` nearest rows for each row (_query, _e) of distinct vectors.

    ``_near`` is the score to 12 decimals, by which rows are ranked. Each task holds one shard and a
    block of about ``QUERY_BLOCK`` queries.
    """
    shards = (index.agg(F.max("_shard")).first()[0] or 0) + 1
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    asked = queries.select(
        "_query", "_e",
        F.size("_e").alias("_to_d"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_to_shard"),
        F.pmod(F.xxhash64("_query"), F.lit(blocks)).cast("int").alias("_to_block"),
    )
    copies = index.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def look(nodes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"_query": [], "_id": [], "_score": [], "_near": []}
        if len(nodes) and len(asked):
            nodes = nodes.sort_values("_node")
            vectors = _scaled(np.stack([np.frombuffer(v) for v in nodes["_vector"]]))
            lead, ids = nodes["_lead"].to_numpy(), nodes["_ids"].tolist()
            leads = int((lead == np.arange(len(lead))).sum())
            edges = np.stack([np.frombuffer(e, dtype=np.int32) for e in nodes["_edges"].iloc[:leads]])
            x = _unit(vectors[:leads])
            by_lead = np.argsort(lead, kind="stable")  # a lead, then its followers
            cut = np.searchsorted(lead[by_lead], np.arange(leads + 1))
            lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            first = np.array([v[0] for v in ids])
            numbers = asked["_query"].to_numpy()
            raw = _scaled(np.stack(asked["_e"].to_numpy()).astype(np.float64))
            for at in range(0, len(raw), 256):
                part = raw[at : at + 256]
                found = beam_search(x, edges, 0, _unit(part), max(beam, top))[0]
                for k, query in enumerate(part):
                    near = np.concatenate([by_lead[cut[v] : cut[v + 1]] for v in found[k] if v >= 0])
                    score = vectors[near] @ query / (math.sqrt(query @ query) * lengths[near])
                    rounded = np.round(score, 12)
                    best = np.lexsort((first[near], -rounded))[:top]
                    flat = sorted((-rounded[i], v, score[i]) for i in best for v in ids[near[i]])[:top]
                    out["_query"] += [numbers[at + k]] * len(flat)
                    out["_id"] += [v for _, v, _ in flat]
                    out["_score"] += [s for _, _, s in flat]
                    out["_near"] += [-r for r, _, _ in flat]
        return pd.DataFrame(out).astype(
            {"_query": "int64", "_id": "int64", "_score": "float64", "_near": "float64"}
        )

    found = (
        copies.groupBy("_d", "_shard", "_block")
        .cogroup(asked.groupBy("_to_d", "_to_shard", "_to_block"))
        .applyInPandas(look, "_query bigint, _id bigint, _score double, _near double")
    )
    best = Window.partitionBy("_query").orderBy(F.desc("_near"), "_id")
    return found.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= top).drop("_r")


def nearest(table: DataFrame, is_query, top: int = 5, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the nearest other rows of each row for which ``is_query(id)`` holds."""
    ship_code(table.sparkSession)
    vectors = settle(usable(table, id_column, vector_column), "ann_vectors")
    index = build_index(vectors, top + 1)
    asked = vectors.filter(is_query(F.col("_id")))
    # queries with equal vectors are searched once
    distinct = settle(asked.groupBy("_e").agg(F.min("_id").alias("_query")), "ann_queries")
    found = settle(search(index, distinct, top + 1), "ann_found")
    each = asked.join(distinct, "_e").select(F.col("_id").alias("query_id"), "_query")
    rank = Window.partitionBy("query_id").orderBy(F.desc("_near"), "_id")
    return (
        each.join(found, "_query")
        .filter(F.col("_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= top)
        .select("query_id", "rank", F.col("_id").alias("vec_id"), F.col("_score").alias("score"))
    )
