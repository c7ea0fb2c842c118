"""Hard negatives by an inverted multi-index.

Vectors become whole numbers, so scores are exact. Each half of a vector is
assigned to the nearest of the codes of that half; two codes make a cell. The sum
of the anchor's products with both codes, each raised by the radius of the code
times the length of the anchor's half, bounds every score in the cell. Codes,
radii and lengths are whole numbers, too, rounded up, so bounds hold exactly and
are the same wherever they are computed.

A heap over the sums of the two sorted lists of half bounds visits cells from the
highest bound on (the multi-sequence order), first until they hold ``first_rows``
rows. That gives a threshold, and then all cells are visited whose bound reaches
it: what is left out can't enter the result. This is done twice, for the positives
and then for the negatives of each positive's window of scores, which is certified
once its last negative, or its lower end, is above the bounds of all other cells.

The rows of a cell are packed in blocks, and visits name a block; so a cell with
much of the data is many units of work. Anchors visit in packs, and a task keeps
the best of what it has seen only.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.frames import map_batches, written


@dataclass(frozen=True)
class Settings:
    """At most ``sample`` vectors of a length fit its codes, at most ``codes`` for a half, about one cell
    for ``cell_rows`` rows. These bound what the driver holds and hands to the tasks; all rows are indexed."""

    sample: int = 16_384
    codes: int = 256
    cell_rows: int = 512
    rounds: int = 6
    first_rows: int = 2048
    block: int = 256
    pack: int = 64


@dataclass(frozen=True)
class Codes:
    """Codes, radii and cell sizes for vectors of one length."""

    halves: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray


_LARGEST = 2.0**55  # of scores, which a window multiplies by its ends


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole vectors."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if top < _LARGEST:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    raise ValueError("scores don't fit into 64 bits")


def _root(squares: np.ndarray) -> np.ndarray:
    """Square roots of whole numbers, rounded up."""
    return np.array([math.isqrt(int(s) - 1) + 1 if s > 0 else 0 for s in squares], np.int64)


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, : x.shape[1] // 2], x[:, x.shape[1] // 2 :]


def _squares(x: np.ndarray) -> np.ndarray:
    if float(np.abs(x).max(initial=0)) ** 2 * x.shape[1] >= _LARGEST:
        raise ValueError("scores don't fit into 64 bits")
    return (x.astype(np.int64) ** 2).sum(1)


def nearest(x: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest code of each row, the first of equally near ones, and the squared distance."""
    away = _squares(x)[:, None] - 2 * products(x, codes) + _squares(codes)[None]
    best = away.argmin(1)
    return best, away[np.arange(len(x)), best]


def fit_codes(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """k-means from evenly spaced rows, rounded to whole numbers; empty clusters keep their code."""
    codes = x[np.linspace(0, len(x) - 1, k).astype(int)].astype(np.int64)
    for _ in range(rounds):
        best = np.concatenate([nearest(x[i : i + 4096], codes)[0] for i in range(0, len(x), 4096)])
        n = np.bincount(best, minlength=k)
        for c in np.flatnonzero(n):
            codes[c] = np.rint(x[best == c].mean(0))
    return codes


def _matrix(blobs, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.int32).reshape(len(blobs), dims)


def _whole(scale: float):
    """Rows whose vectors are usable, scaled and rounded down to whole numbers."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, out, dims = [], [], []
            for k, vector in enumerate(batch.column("vector").to_pylist()):
                if vector is None or any(v is None for v in vector):
                    continue
                x = np.asarray(vector, np.float64)
                if not np.isfinite(x).all():
                    continue
                x = np.floor(scale * x)
                if len(x) and np.abs(x).max() >= 2**31:
                    raise ValueError("a component is too large for exact scores")
                keep.append(k)
                out.append(x.astype(np.int32).tobytes())
                dims.append(len(x))
            at = pa.array(keep, pa.int64())
            columns = [batch.column(c).take(at) for c in ("id", "label")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(dims, pa.int32()), pa.array(out, pa.binary())], names=["id", "label", "dims", "q"]
            )

    return whole


def _assigned(codes: dict[int, tuple[np.ndarray, np.ndarray]]):
    """Cell of each row, and the squared distances of its halves to their codes."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, blobs = batch.column("dims").to_numpy(), batch.column("q").to_pylist()
            found = np.zeros((len(blobs), 4), np.int64)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                x = _matrix([blobs[i] for i in at], d)
                for h, (own, code) in enumerate(zip(_halves(x), codes[d])):
                    found[at, h], found[at, 2 + h] = nearest(own, code)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(found[:, k]) for k in range(4))],
                names=[*batch.schema.names, "i", "j", "far1", "far2"],
            )

    return assign


_BLOCK = "dims int, cell long, chunk long, ids binary, labels binary, units binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a block, which follow each other by id, packed into one row."""
    unit, rows = None, []

    def closed() -> pa.RecordBatch:
        ids, labels, units = zip(*rows)
        columns = [[v] for v in (*unit, np.array(ids, np.int64).tobytes(), np.array(labels, np.int64).tobytes(), b"".join(units))]
        kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), names=["dims", "cell", "chunk", "ids", "labels", "units"])

    for batch in batches:
        for *own, i, label, q in zip(*(batch.column(c).to_pylist() for c in ("dims", "cell", "chunk", "id", "label", "q"))):
            if own != unit and rows:
                yield closed()
                rows = []
            unit = own
            rows.append((i, label, q))
    if rows:
        yield closed()


def half_bounds(x: np.ndarray, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores that each code of each half adds for one vector."""
    out = []
    for own, code, radius in zip(_halves(x[None]), codes.halves, codes.radii):
        out.append(products(own, code)[0] + _root(products(own, own).ravel())[0] * radius)
    return out[0], out[1]


def multi_sequence(one: np.ndarray, two: np.ndarray, counts: np.ndarray, enough: int) -> int:
    """The bound down to which cells are visited, from the highest on, until they hold ``enough`` rows."""
    first, second = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    heap = [(-int(one[first[0]] + two[second[0]]), 0, 0)]
    seen, bound = 0, 0
    while heap and seen < enough:
        bound, a, b = heapq.heappop(heap)
        seen += int(counts[first[a], second[b]])
        if b + 1 < len(second):
            heapq.heappush(heap, (-int(one[first[a]] + two[second[b + 1]]), a, b + 1))
        if b == 0 and a + 1 < len(first):
            heapq.heappush(heap, (-int(one[first[a + 1]] + two[second[0]]), a + 1, 0))
    return -bound


_NONE = -(2**62)


def _visits(index: dict[int, Codes], s: Settings, certify: bool):
    """Packs of anchors for each block that they visit.

    First all cells down to a bound, which a heap finds for each anchor; then
    (``certify``) those below it that still reach ``least``, the score from which
    on rows may enter the anchor's result.
    """

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "label", "dims", "q", "tops", "least"]
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in names)))
            for at in range(0, len(rows), s.pack):
                by_cell: dict[tuple[int, int], list[tuple]] = {}
                for row in rows[at : at + s.pack]:
                    codes = index[row[2]]
                    one, two = half_bounds(_matrix([row[3]], row[2])[0], codes)
                    bound = one[:, None] + two[None]
                    until = multi_sequence(one, two, codes.counts, s.first_rows)
                    visited = (bound < until) & (bound >= row[5]) if certify else bound >= until
                    for cell in np.flatnonzero(visited & (codes.counts > 0)).tolist():
                        by_cell.setdefault((row[2], cell), []).append(row)
                for (d, cell), own in by_cell.items():
                    ids, labels, _, units, tops, _ = zip(*own)
                    width = max(map(len, tops))
                    tops = np.array([[*t, *[_NONE] * (width - len(t))] for t in tops], np.int64)
                    chunks = -(-int(index[d].counts.ravel()[cell]) // s.block)
                    values = (d, cell, None, np.array(ids, np.int64).tobytes(), np.array(labels, np.int64).tobytes(), b"".join(units), tops.tobytes())
                    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
                    columns = [pa.array([v] * chunks, k) for v, k in zip(values, kinds)]
                    columns[2] = pa.array(range(chunks), pa.int64())
                    yield pa.RecordBatch.from_arrays(columns, names=["dims", "cell", "chunk", "anchors", "own_labels", "own_units", "tops"])

    return visit


_VISIT = "dims int, cell long, chunk long, anchors binary, own_labels binary, own_units binary, tops binary"
_FOUND = ["anchor", "slot", "score", "id"]


def _best(found: np.ndarray, keep: int) -> np.ndarray:
    """The first ``keep`` rows of each anchor and slot: higher scores first, then smaller ids."""
    found = found[np.lexsort((found[:, 3], -found[:, 2], found[:, 1], found[:, 0]))]
    fresh = np.append(True, (found[1:, :2] != found[:-1, :2]).any(1))
    start = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    return found[np.arange(len(found)) - start < keep]


def _scored(keep: int, low: tuple[int, int] | None):
    """The best rows of each visited block: of the anchor's label, or, given the window ``low``, of other
    labels and with scores from ``low`` times a top up to it, one slot for each top."""

    def pairs(row: dict) -> np.ndarray:
        d = row["dims"]
        ids, labels, anchors, own = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "anchors", "own_labels"))
        sides = (np.frombuffer(row[c], np.int32).reshape(n, d) for c, n in (("own_units", len(anchors)), ("units", len(ids))))
        scores = products(*sides)
        same = own[:, None] == labels[None]
        if low is None:
            slots = [(0, same & (anchors[:, None] != ids[None]))]
        else:
            tops = np.frombuffer(row["tops"], np.int64).reshape(len(anchors), -1)
            slots = [
                (k, ~same & (scores <= t) & (low[1] * scores >= low[0] * t) & (t != _NONE))
                for k, t in enumerate(tops.T[:, :, None])
            ]
        out = []
        for slot, fits in slots:
            line, at = np.nonzero(fits)
            own_found = np.stack([anchors[line], np.full(len(line), slot), scores[line, at], ids[at]], 1)
            out.append(_best(own_found, keep) if len(line) else own_found)
        return np.concatenate(out)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                own = pairs(row)
                held.append(own)
                size += len(own)
                if size > 100_000:
                    held = [_best(np.concatenate(held), keep)]
                    size = len(held[0])
                    if size > 50_000:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, held[0].T)), names=_FOUND)
                        held, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, _best(np.concatenate(held), keep).T)), names=_FOUND)

    return score


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _searched(anchors: DataFrame, blocks: DataFrame, index: dict, s: Settings, certify: bool, keep: int, low) -> DataFrame:
    visits = map_batches(anchors.select("id", "label", "dims", "q", "tops", "least"), _visits(index, s, certify), _VISIT)
    met = visits.join(blocks, ["dims", "cell", "chunk"])
    return map_batches(met, _scored(keep, low), "anchor long, slot long, score long, id long")


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    is_anchor: Column | None = None,
    n_positives: int = 5,
    n_negatives: int = 5,
    low: tuple[int, int] = (80, 100),
    scale: float = 256.0,
    settings: Settings = Settings(),
) -> DataFrame:
    """``anchor``, ``positive``, ``rank``, ``negative``, ``positive_score``, ``negative_score``.

    Scores are inner products of the vectors' components times ``scale``, rounded
    down; higher ones come first, equal ones by id. Anchors are the rows for which
    ``is_anchor`` (over the columns of ``vectors``) holds, by default all. The
    positives of an anchor are its first ``n_positives`` other rows of its label;
    for each, the first ``n_negatives`` rows of other labels are returned whose
    score is at most the positive's and at least ``low`` (numerator, denominator)
    of it. A positive with a negative score has none.

    Rows with a null id, label or vector, or a null or non-finite component take
    no part. Vectors of different lengths never meet. Equal rows count once; of an
    id with different rows, the one of the smallest label and bytes asks, and no
    anchor meets rows of its own id. Ids and labels must be whole numbers.
    """
    s = settings
    flag = F.lit(True) if is_anchor is None else F.coalesce(is_anchor, F.lit(False))
    base = vectors.select(
        vectors[id_col].cast("long").alias("id"), vectors[label_col].cast("long").alias("label"),
        vectors[vector_col].cast("array<double>").alias("vector"), flag.alias("asks"),
    )
    base = base.where("id IS NOT NULL AND label IS NOT NULL")
    asking = base.where("asks").select("id").distinct()
    whole = map_batches(base.select("id", "label", "vector"), _whole(scale), "id long, label long, dims int, q binary")
    whole = written(whole.dropDuplicates(["id", "label", "dims", "q"]))

    codes = {}
    for row in whole.groupBy("dims").agg(F.count("*").alias("n")).orderBy("dims").collect():
        d = row["dims"]
        sample = whole.where(F.col("dims") == d).orderBy(F.xxhash64("q"), "q").limit(s.sample).select("q").collect()
        x = _matrix([bytes(r["q"]) for r in sample], d)
        k = max(1, min(s.codes, math.isqrt(row["n"] // s.cell_rows), len(x)))
        codes[d] = tuple(fit_codes(own, k, s.rounds) for own in _halves(x))
    kind = "id long, label long, dims int, q binary, i long, j long, far1 long, far2 long"
    placed = written(map_batches(whole, _assigned(codes), kind))
    index = {}
    cells = placed.groupBy("dims", "i", "j").agg(F.count("*").alias("n"), F.max("far1").alias("far1"), F.max("far2").alias("far2"))
    for row in cells.collect():  # at most the square of ``codes`` for each length
        d = row["dims"]
        k = len(codes[d][0])
        own = index.setdefault(d, Codes(codes[d], (np.zeros(k, np.int64), np.zeros(k, np.int64)), np.zeros((k, k), np.int64)))
        own.counts[row["i"], row["j"]] = row["n"]
        for radius, code, far in zip(own.radii, (row["i"], row["j"]), (row["far1"], row["far2"])):
            radius[code] = max(radius[code], _root(np.array([far]))[0])

    width = F.create_map(*[F.lit(v) for d, c in codes.items() for v in (d, len(c[0]))]) if codes else F.lit(None)
    celled = placed.withColumn("cell", F.col("i") * width[F.col("dims")] + F.col("j")) if codes else placed.withColumn("cell", F.col("i"))
    numbers = cells.select("dims", "i", "j", F.ceil(F.col("n") / s.block).alias("chunks"))
    chunk = F.pmod(F.xxhash64("id", "label"), "chunks").alias("chunk")
    dealt = celled.join(numbers, ["dims", "i", "j"]).select("dims", "cell", chunk, "id", "label", "q")
    dealt = dealt.repartition("dims", "cell", "chunk").sortWithinPartitions("dims", "cell", "chunk", "id")
    blocks = written(map_batches(dealt, _blocks, _BLOCK))

    none = F.array().cast("array<long>")
    own = F.min(F.struct("label", "q", "dims", "i", "j")).alias("own")
    anchors = celled.join(asking, "id", "left_semi").groupBy("id").agg(own).select("id", "own.*")
    anchors = written(anchors.repartitionByRange("dims", "i", "j", "id").sortWithinPartitions("dims", "i", "j", "id"))
    asked = anchors.select("id", "label", "dims", "q", none.alias("tops"), F.lit(_NONE).alias("least"))

    def complete(asked: DataFrame, keep: int, low, least) -> DataFrame:
        """Both rounds of a search; ``least`` turns the first one's results into scores that can't be beaten."""
        first = written(_searched(asked, blocks, index, s, False, keep, low))
        again = least(asked, _ranked(first, keep))
        return written(_ranked(first.union(_searched(again, blocks, index, s, True, keep, low)), keep))

    def from_last(asked: DataFrame, ranked: DataFrame) -> DataFrame:
        last = ranked.where(F.col("rank") == n_positives).select(F.col("anchor").alias("id"), F.col("score").alias("last"))
        return asked.drop("least").join(last, "id", "left").withColumn("least", F.coalesce("last", F.lit(_NONE))).drop("last")

    positives = complete(asked, n_positives, None, from_last)
    tops = positives.groupBy("anchor").agg(F.sort_array(F.collect_list("score"), asc=False).alias("tops"))
    windows = anchors.join(tops, anchors["id"] == tops["anchor"]).select("id", "label", "dims", "q", "tops", F.lit(_NONE).alias("least"))
    windows = written(windows)

    def from_windows(asked: DataFrame, ranked: DataFrame) -> DataFrame:
        full = ranked.where(F.col("rank") == n_negatives).select(F.col("anchor").alias("id"), F.col("slot"), F.col("score").alias("last"))
        ends = asked.where(F.get("tops", F.lit(0)) >= 0).select("id", F.posexplode("tops").alias("slot", "top")).where("top >= 0")
        ends = ends.withColumn("slot", F.col("slot").cast("long")).join(full, ["id", "slot"], "left")
        lower = F.ceil(F.lit(low[0]) * F.col("top") / F.lit(low[1])) - 1
        open_ = ends.groupBy("id").agg(F.min(F.coalesce("last", lower)).alias("least"))
        return asked.drop("least").join(open_, "id")

    negatives = complete(windows, n_negatives, low, from_windows)
    first = positives.select(
        "anchor", (F.col("rank") - 1).cast("long").alias("slot"), F.col("id").alias("positive"), F.col("score").alias("positive_score")
    )
    return negatives.withColumnRenamed("id", "negative").withColumnRenamed("score", "negative_score").join(first, ["anchor", "slot"]).select(
        "anchor", "positive", "rank", "negative", "positive_score", "negative_score"
    )
