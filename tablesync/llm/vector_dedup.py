"""Embedding near-dedup by robust-pruned flat graphs.

Equal directions become one node. Nodes are dealt to the shards of their nearest
centroids, so that shards overlap; each shard builds a flat graph with robust
pruning, and the neighbours that a node got in its shards are united. In each
shard every member searches that graph: greedily from the medoid with a beam, and
from the nodes in range on to their neighbours until no more are in range. Links
are verified in double precision. A link to a member of a shard that the other
end was not dealt to leads on: the two shards are compared as a whole, until no
link leads to two shards not yet compared. The recall is audited against brute
force for bounded sets of queries, of any and of those with links; as long as it
is too low, the search is repeated wider, and in the end it fails.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.components import components
from tablesync.llm.frames import map_batches, written

MIN_COSINE = 0.95


@dataclass(frozen=True)
class Settings:
    """``sample`` vectors fit at most ``max_shards`` centroids, about one for ``shard`` vectors.

    These bound what is broadcast; all vectors are indexed and all are queries.
    A shard that outgrows ``shard`` is worked on in blocks, so that memory grows
    with its vectors and not with their square. ``audit`` queries, the first by a
    hash of their id, are compared with all vectors, and so are as many with links,
    half of them those with the most. A recall under ``least`` is an error.
    """

    shard: int = 1500
    max_shards: int = 8192
    overlap: int = 3
    sample: int = 32_768
    rounds: int = 8
    candidates: int = 64
    degree: int = 24
    alpha: float = 1.2
    beam: int = 32
    audit: int = 64
    recall: float = 0.95
    least: float = 0.9
    tries: int = 3
    block: int = 1024


def unit(vector) -> np.ndarray | None:
    """Direction in double precision; None for vectors without one."""
    if vector is None or len(vector) == 0 or any(x is None for x in vector):
        return None
    x = np.asarray(vector, np.float64)
    if not np.isfinite(x).all() or not x.any():
        return None
    x = x / np.abs(x).max()
    return x / np.sqrt((x * x).sum())


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units, and a digest by which equal directions (equal but for a positive factor) meet."""
    for batch in batches:
        own = [unit(v) for v in batch.column("vector").to_pylist()]
        rounded = [None if u is None else (np.round(u, 12) + 0.0).tobytes() for u in own]
        digest = [None if r is None else xxhash.xxh3_128_digest(r) for r in rounded]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(digest, pa.binary()),
             pa.array([None if u is None else u.tobytes() for u in own], pa.binary()),
             pa.array([0 if u is None else len(u) for u in own], pa.int32())],
            names=["id", "digest", "unit", "dims"],
        )


def _matrix(units) -> np.ndarray:
    return np.stack([np.frombuffer(u, np.float64) for u in units])


def fit_centroids(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Spherical k-means from evenly spaced rows; empty clusters keep their centroid."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        order = np.argsort(near, kind="stable")
        starts = np.searchsorted(near[order], np.arange(k))
        some = np.flatnonzero(np.diff(np.append(starts, len(x))))
        sums = np.add.reduceat(x[order], starts[some], axis=0)
        norms = np.sqrt((sums * sums).sum(1, keepdims=True))
        c[some] = np.where(norms > 0, sums / np.maximum(norms, 1e-300), c[some])
    return c


def _assigned(centroids: dict[int, np.ndarray], overlap: int, first: dict[int, int]):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, dims = batch.column("unit").to_pylist(), batch.column("dims").to_numpy()
            shards: list = [None] * len(units)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                near = -(_matrix([units[i] for i in at]) @ centroids[int(d)].T)
                k = min(overlap, near.shape[1])
                best = np.argpartition(near, k - 1, axis=1)[:, :k]
                order = np.argsort(np.take_along_axis(near, best, 1), axis=1, kind="stable")
                best = np.take_along_axis(best, order, 1) + first[int(d)]  # the first is the home
                for i, own in zip(at, best.astype(np.int32).tolist()):
                    shards[i] = own
            out = pa.array(shards, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("unit"), out], names=["id", "unit", "shards"])

    return assign


def pruned_graph(x: np.ndarray, s: Settings) -> list[np.ndarray]:
    """Neighbours of each row: of its nearest rows those that no chosen one is much nearer to.

    Edges are then made mutual; of too many the nearest stay.
    """
    n, k = len(x), min(s.candidates, len(x) - 1)
    chosen: list[list[int]] = [[] for _ in range(n)]
    if k <= 0:
        return [np.empty(0, np.int64) for _ in range(n)]
    for at in range(0, n, s.block):
        rows = np.arange(at, min(at + s.block, n))
        near = x[rows] @ x.T
        near[np.arange(len(rows)), rows] = -2
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(near, best, 1), axis=1, kind="stable")
        best = np.take_along_axis(best, order, 1)
        away = 2 - 2 * np.take_along_axis(near, best, 1)  # squared distances
        own = x[best]
        alive = np.ones(best.shape, bool)
        for _ in range(s.degree):
            pick = alive.argmax(1)
            some = np.flatnonzero(alive[np.arange(len(rows)), pick])
            if not len(some):
                break
            for r in some:
                chosen[rows[r]].append(int(best[r, pick[r]]))
            between = 2 - 2 * np.einsum("rcd,rd->rc", own[some], own[some, pick[some]])
            alive[some] &= s.alpha**2 * between > away[some]
            alive[some, pick[some]] = False
    mutual: list[set[int]] = [set(c) for c in chosen]
    for i, own in enumerate(chosen):
        for j in own:
            mutual[j].add(i)
    out = []
    for i, own in enumerate(mutual):
        near = np.fromiter(own, np.int64, len(own))
        if len(near) > 2 * s.degree:
            near = near[np.argsort(-(x[near] @ x[i]), kind="stable")[: 2 * s.degree]]
        out.append(near)
    return out


def _padded(neighbours: list[np.ndarray]) -> np.ndarray:
    width = max(1, max(map(len, neighbours)))
    out = np.full((len(neighbours), width), -1, np.int64)
    for i, own in enumerate(neighbours):
        out[i, : len(own)] = own
    return out


def range_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, radius: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, row) with a product of at least ``radius`` that the search comes upon."""
    n, q = len(x), len(queries)
    medoid = int((x @ x.mean(0)).argmax())
    beam = min(beam, n)
    nodes = np.full((q, beam), -1, np.int64)
    near = np.full((q, beam), -3.0)
    done = np.zeros((q, beam), bool)
    nodes[:, 0], near[:, 0] = medoid, x[queries] @ x[medoid]
    lines = np.arange(q)
    while len(lines):
        open_ = np.where((nodes[lines] >= 0) & ~done[lines], near[lines], -4.0)
        pick = open_.argmax(1)
        lines, pick = lines[open_.max(1) > -4], pick[open_.max(1) > -4]
        if not len(lines):
            break
        done[lines, pick] = True
        more = graph[nodes[lines, pick]]
        known = (more[:, :, None] == nodes[lines][:, None, :]).any(2) | (more < 0)
        value = np.where(known, -3.0, np.einsum("lwd,ld->lw", x[more], x[queries[lines]]))
        all_near = np.concatenate([near[lines], value], 1)
        all_nodes = np.concatenate([nodes[lines], np.where(known, -1, more)], 1)
        all_done = np.concatenate([done[lines], np.zeros(more.shape, bool)], 1)
        best = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        near[lines], nodes[lines], done[lines] = (np.take_along_axis(v, best, 1) for v in (all_near, all_nodes, all_done))
    hit = (nodes >= 0) & (near >= radius)
    line, node = np.repeat(np.arange(q), hit.sum(1)), nodes[hit]
    found = line * n + node
    fresh = found
    while len(fresh):  # from the nodes in range on to their neighbours in range
        more = graph[fresh % n]
        pairs = (np.repeat(fresh // n, graph.shape[1]) * n + more.ravel())[more.ravel() >= 0]
        pairs = np.setdiff1d(np.unique(pairs), found, assume_unique=False)
        value = np.concatenate([np.einsum("pd,pd->p", x[queries[p // n]], x[p % n]) for p in np.array_split(pairs, len(pairs) // 65536 + 1)]) if len(pairs) else np.empty(0)
        fresh = pairs[value >= radius]
        found = np.union1d(found, fresh)
    return found // n, found % n


def _build(s: Settings):
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        ids = frame["id"].to_numpy()
        graph = pruned_graph(_matrix(frame["unit"]), s)
        return pd.DataFrame({"id": ids, "near": [ids[own] for own in graph]})

    return build


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that suffice to connect what all links connect."""
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        i, j = find(i), find(j)
        if i != j:
            parent[max(i, j)] = min(i, j)
            out.append((i, j))
    return out


def _shards_of(lists, overlap: int) -> np.ndarray:
    return np.stack([np.pad(np.asarray(v, np.int64), (0, overlap - len(v)), constant_values=-1) for v in lists])


def _search(s: Settings, radius: float):
    """For each member of a shard: weight of the linked members at home there, a link for components,
    and, in ``more``, the shards to be compared with its own home."""

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        ids, weight, own = frame["id"].to_numpy(), frame["weight"].to_numpy(), int(frame["shard"].iloc[0])
        x, n = _matrix(frame["unit"]), len(frame)
        place = {i: k for k, i in enumerate(ids.tolist())}
        graph = _padded([np.array([place[i] for i in near if i in place], np.int64) for near in frame["near"]])
        pairs = [np.empty(0, np.int64)]
        for at in range(0, n, s.block):
            rows = np.arange(at, min(at + s.block, n))
            line, node = range_search(x, graph, rows, radius - 1e-9, s.beam)
            a, b = rows[line], node
            pairs.append(np.minimum(a, b) * n + np.maximum(a, b))
        pairs = np.unique(np.concatenate(pairs))
        a, b = pairs // n, pairs % n
        a, b = a[a != b], b[a != b]
        linked = np.concatenate([np.empty(0, bool), *(
            np.einsum("pd,pd->p", x[a[i : i + 65536]], x[b[i : i + 65536]]) >= radius for i in range(0, len(a), 65536)
        )])
        a, b = a[linked], b[linked]
        shards = _shards_of(frame["shards"], s.overlap)
        links, more = np.zeros(n, np.int64), [set() for _ in range(n)]
        for one, two in ((a, b), (b, a)):
            here = shards[two, 0] == own
            np.add.at(links, one[here], weight[two[here]])
            first = {}
            for k in range(s.overlap):
                codes, at = np.unique(shards[one, 0] * (1 << 32) + shards[two, k] + 1, return_index=True)
                first |= dict(zip(codes.tolist(), one[at].tolist()))
            for code, row in first.items():
                home, shard = code >> 32, (code & 0xFFFFFFFF) - 1
                if shard >= 0 and shard != home:
                    more[row].add(shard)
        near = {j: i for i, j in ((min(t), max(t)) for t in _roots(n, a, b))}
        return pd.DataFrame({
            "id": ids, "links": links, "to": [ids[near[k]] if k in near else None for k in range(n)],
            "home": shards[:, 0], "more": [sorted(m) for m in more],
        }).astype({"to": "Int64"})

    return search


def _blocks(s: Settings):
    """The vectors at home in a shard, packed in rows of at most ``block``."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        parts = [frame.iloc[i : i + s.block] for i in range(0, len(frame), s.block)]
        return pd.DataFrame({
            "home": [int(p["home"].iloc[0]) for p in parts],
            "ids": [p["id"].to_numpy() for p in parts],
            "weights": [p["weight"].to_numpy() for p in parts],
            "units": [b"".join(p["unit"]) for p in parts],
            "shards": [_shards_of(p["shards"], s.overlap).ravel() for p in parts],
        })

    return pack


def _compared(radius: float):
    """All vectors of one shard against all of another; what the searches have counted is left out.

    A task sums up what it finds, so that its rows grow with the vectors it sees.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: dict[int, int] = {}
        parent: dict[int, int] = {}
        more: set[tuple[int, int]] = set()

        def find(i: int) -> int:
            while parent.setdefault(i, i) != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for batch in batches:
            for row in range(batch.num_rows):
                side = []
                for c in "ab":
                    value = {k: batch.column(f"{c}_{k}")[row] for k in ("home", "ids", "weights", "units", "shards")}
                    ids = np.array(value["ids"].values)
                    units = np.frombuffer(value["units"].as_py(), np.float64).reshape(len(ids), -1)
                    shards = np.array(value["shards"].values).reshape(len(ids), -1)
                    side.append((value["home"].as_py(), ids, np.array(value["weights"].values), units, shards))
                linked = side[0][3] @ side[1][3].T >= radius
                if not linked.any():
                    continue
                for (home, ids, _, _, shards), (other, _, weights, _, theirs), found in (
                    (side[0], side[1], linked), (side[1], side[0], linked.T)
                ):
                    fresh = ~(shards == other).any(1)
                    for i, n in zip(ids[fresh].tolist(), (found[fresh] @ weights).tolist()):
                        if n:
                            links[i] = links.get(i, 0) + n
                    met = np.unique(theirs[found.any(0)])
                    more |= {(min(home, m), max(home, m)) for m in met.tolist() if m >= 0 and m != home}
                one, two = side[0][1], side[1][1]
                before = None
                while before is None or (one != before[0]).any() or (two != before[1]).any():
                    before = one, two
                    one = np.minimum(one, np.where(linked, two[None], 1 << 62).min(1))
                    two = np.minimum(two, np.where(linked, one[:, None], 1 << 62).min(0))
                for i, j in zip([*side[0][1].tolist(), *side[1][1].tolist()], [*one.tolist(), *two.tolist()]):
                    if i != j:
                        i, j = find(i), find(j)
                        parent[max(i, j)] = min(i, j)
        ids = sorted({*links, *parent})
        some = sorted(more)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*ids, *[None] * len(some)], pa.int64()), pa.array([*(links.get(i, 0) for i in ids), *[0] * len(some)], pa.int64()),
             pa.array([*(find(i) if i in parent else None for i in ids), *[None] * len(some)], pa.int64()),
             pa.array([*[None] * len(ids), *(a for a, _ in some)], pa.int32()), pa.array([*[None] * len(ids), *(b for _, b in some)], pa.int32())],
            names=["id", "links", "to", "a", "b"],
        )

    return compare


def _across(placed: DataFrame, searched: DataFrame, s: Settings, radius: float) -> DataFrame:
    """``id``, ``links`` and ``to`` of the searches, and of the pairs of shards that links lead to."""
    out = searched.select("id", "links", "to")
    a, b = F.least("home", "shard"), F.greatest("home", "shard")
    left = written(searched.select("home", F.explode("more").alias("shard")).select(a.alias("a"), b.alias("b")).distinct())
    if left.isEmpty():
        return out
    kind = "home int, ids array<long>, weights array<long>, units binary, shards array<int>"
    blocks = written(placed.withColumn("home", F.get("shards", F.lit(0))).groupBy("home").applyInPandas(_blocks(s), kind))
    one, two = (blocks.select(*(F.col(n).alias(f"{c}_{n}") for n in blocks.columns)) for c in "ab")
    done = left
    while not left.isEmpty():
        pairs = left.join(one, F.col("a") == F.col("a_home")).join(two, F.col("b") == F.col("b_home")).drop("a", "b")
        found = written(map_batches(pairs, _compared(radius), "id long, links long, `to` long, a int, b int"))
        out = out.union(found.where("id is not null").select("id", "links", "to"))
        left = written(found.where("a is not null").select("a", "b").distinct().join(done, ["a", "b"], "left_anti"))
        done = done.union(left)
    return out


def _exact(queries: np.ndarray, radius: float, digests: list[bytes]):
    """Links of the audited queries, by brute force in blocks of all vectors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(queries), np.int64)
        for batch in batches:
            units, weight = batch.column("unit").to_pylist(), batch.column("weight").to_numpy()
            same = [k for k, u in enumerate(units) if len(u) == queries.shape[1] * 8]
            for at in range(0, len(same), 4096):
                own = same[at : at + 4096]
                total += ((queries @ _matrix([units[k] for k in own]).T) >= radius) @ weight[own]
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(total)], names=["digest", "n"])

    return count


def _recall(nodes: DataFrame, placed: DataFrame, links: DataFrame, s: Settings, radius: float, truth: dict[int, int]) -> float:
    """Share of the links of the audited vectors that were found; ``truth`` keeps what brute force has counted."""
    order = F.xxhash64("digest", F.lit(1))
    counted = nodes.join(links, "id", "left").select("id", "unit", "digest", "weight", F.coalesce("links", F.lit(0)).alias("links"))
    some = counted.where("links > 0")
    parts = (counted.orderBy(order).limit(s.audit), some.orderBy(order).limit(s.audit - s.audit // 2),
             some.orderBy(F.desc("links"), order).limit(s.audit // 2))
    audited = {r["id"]: r for part in parts for r in part.collect()}
    new = [r for i, r in audited.items() if i not in truth]
    for d in {len(r["unit"]) for r in new}:
        own = [r for r in new if len(r["unit"]) == d]
        queries, ids = _matrix([bytes(r["unit"]) for r in own]), {bytes(r["digest"]): r["id"] for r in own}
        counts = map_batches(placed.select("unit", "weight"), _exact(queries, radius, [bytes(r["digest"]) for r in own]), "digest binary, n long")
        truth.update({ids[bytes(r["digest"])]: r["n"] for r in counts.groupBy("digest").agg(F.sum("n").alias("n")).collect()})
    wanted = {i: truth[i] - r["weight"] for i, r in audited.items()}
    total = sum(wanted.values())
    return sum(min(audited[i]["links"], n) for i, n in wanted.items()) / total if total else 1.0


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    radius: float = MIN_COSINE,
    settings: Settings = Settings(),
) -> DataFrame:
    """``id``, ``n_links``, ``component``, ``kept`` and ``audited_recall`` of every row.

    Linked are vectors with a cosine of at least ``radius``; copies are linked
    without being compared. ``component`` is the smallest id reachable by links,
    ``kept`` marks it. ``audited_recall`` is the share of the audited queries'
    links that were found. Vectors that are null, empty, zero, or hold null or
    non-finite numbers are linked with nothing, nor are vectors of different
    lengths, or rows without id. Ids must be whole numbers; each row counts.
    """
    spark, s = vectors.sparkSession, settings
    base = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("vector"))
    schema = "id long, digest binary, unit binary, dims int"
    units = written(map_batches(base, _units, schema))
    usable = units.where("digest is not null and id is not null")
    nodes = written(usable.groupBy("digest").agg(
        F.min("id").alias("id"), F.count("*").alias("weight"), F.min_by("unit", "id").alias("unit"), F.first("dims").alias("dims")
    ))

    sizes = nodes.groupBy("dims").agg(F.count("*").alias("n")).orderBy("dims").collect()
    truth: dict[int, int] = {}
    for _ in range(s.tries):
        centroids, first, at = {}, {}, 0
        for row in sizes:
            sample = nodes.where(F.col("dims") == row["dims"]).orderBy(F.xxhash64("digest")).limit(s.sample)
            x = _matrix([bytes(r["unit"]) for r in sample.select("unit").collect()])
            k = int(min(s.max_shards, max(1, row["n"] * s.overlap // s.shard), len(x)))
            centroids[row["dims"]], first[row["dims"]], at = fit_centroids(x, k, s.rounds), at, at + k
        placed = map_batches(nodes.select("id", "unit", "dims"), _assigned(centroids, s.overlap, first), "id long, unit binary, shards array<int>")
        placed = written(placed.join(nodes.select("id", "weight"), "id"))

        members = placed.select("id", "unit", "weight", "shards", F.explode("shards").alias("shard"))
        graphs = members.select("id", "unit", "shard").groupBy("shard").applyInPandas(_build(s), "id long, near array<long>")
        graph = written(graphs.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
        kind = "id long, links long, `to` long, home int, more array<int>"
        searched = written(members.join(graph, "id").groupBy("shard").applyInPandas(_search(s, radius), kind))
        searched = _across(placed, searched, s, radius)
        links = written(searched.groupBy("id").agg(F.sum("links").alias("links")))
        recall = _recall(nodes, placed, links, s, radius, truth)
        if recall >= s.recall:
            break
        s = replace(s, beam=2 * s.beam, overlap=s.overlap + 1)
    if recall < s.least:
        raise RuntimeError(f"only {recall:.3f} of the links of the audited vectors were found")
    joined = components(searched.where("`to` is not null").select(F.col("id").alias("a"), F.col("to").alias("b"))).toDF("node", "component")
    found = nodes.select("digest", F.col("id").alias("node"), "weight").join(links.toDF("node", "links"), "node").join(joined, "node", "left")
    found = written(found.select("digest", (F.col("links") + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")))
    linked = F.col("digest").isNotNull() & F.col("id").isNotNull()
    return (
        units.select("id", "digest").join(found, "digest", "left")
        .select(
            "id",
            F.when(linked, F.col("n_links")).otherwise(F.lit(0).cast("long")).alias("n_links"),
            F.when(linked, F.col("component")).otherwise(F.col("id")).alias("component"),
            F.lit(float(recall)).alias("audited_recall"),
        )
        .withColumn("kept", F.col("id").eqNullSafe(F.col("component")))
    )
