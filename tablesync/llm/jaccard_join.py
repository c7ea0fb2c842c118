"""N-gram Jaccard join by partitions of the universe of n-grams.

Sets of sizes r <= s with a Jaccard similarity of p/q or more differ in at most
H = (r + s) * (q - p) // (q + p) n-grams. n-grams are dealt to segments by a hash;
two sets agree on a segment, or differ there by one, unless they differ by more.
If segments that are indexed whole count 1, segments indexed with all sets of one
n-gram less count 2, and segments that are left out count 0, a total of H + 1 makes
sure that linked sets share an entry. Sizes fall into bands, so narrow that linked
sets are in the same or in neighbouring bands; the largest H of a band and the next
gives its number of segments: H + 1, and some more, as many as are likely to be
empty. Then linked sets agree on a segment that isn't empty, unless both have
that many empty ones; only such sets need entries for empty segments, which
would tie unrelated texts. All segments are indexed whole, but for swaps
by cost: a segment whose entries are shared too often is left out, and the cheapest
one is indexed with its neighbourhood instead.

Copies of a set are one node. Of the sets under an entry, all are first compared
with the one of the smallest id, which is linear in the entries. Then, where an
entry still joins different components, its sets of different components are
compared in blocks, by bounds from small histograms, and verified. So all links
between components are found without giving all pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm import words as W
from tablesync.llm.components import components
from tablesync.llm.frames import bytes_of, discard, map_batches, text_of, written

NGRAM, P, Q = 5, 8, 10
BINS, BLOCK = 256, 1024
_CELL = 1 << 24  # more segments than a band can have
_KEY_BYTES = 6  # keys that meet by chance cost a comparison only
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def ngram_hashes(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text; fewer words make one n-gram."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    values = W.hashes(words)
    size = min(n, len(words))
    out = np.full(len(words) - size + 1, np.uint64(size))
    for k in range(size):
        out = W.mixed(out * _ONE + values[k : len(values) - size + 1 + k])
    return np.unique(out)


@lru_cache(1)
def bands(p: int, q: int, largest: int = 1 << 34) -> np.ndarray:
    """Smallest size of each band."""
    out = [1]
    while out[-1] < largest:
        out.append(out[-1] * q // p + 1)
    return np.array(out, np.int64)


@lru_cache(None)
def segments(band: int, p: int, q: int) -> tuple[int, int]:
    """Number of segments for pairs whose smaller set is in the band, and by how much it is over H."""
    least, small = int(bands(p, q)[band]), int(bands(p, q)[band + 1]) - 1
    most = (small + small * q // p) * (q - p) // (q + p)
    if most == 0:  # only equal sets are linked
        return 1, 1
    empty = (most + 1) * math.exp(-least / (most + 1))
    over = 1 + math.ceil(empty + 2 * math.sqrt(empty))
    return most + over, over


def _segment_of(grams: np.ndarray, count: int) -> np.ndarray:
    return (W.mixed(grams ^ _ONE) % np.uint64(count)).astype(np.int64)


def _keys(sums: np.ndarray, band: int, segment: np.ndarray) -> np.ndarray:
    mixed = W.mixed(sums ^ W.mixed((np.uint64(band) << np.uint64(32)) + segment.astype(np.uint64)))
    return mixed >> np.uint64(64 - 8 * _KEY_BYTES)


def entries(grams: np.ndarray, band: int, p: int, q: int) -> np.ndarray:
    """A key for each segment: the set in it, whatever its order. 0: no entry is needed."""
    count, over = segments(band, p, q)
    if count == 1:
        return np.empty(0, np.uint64)
    segment = _segment_of(grams, count)
    order = np.argsort(segment, kind="stable")
    sums = np.concatenate([[np.uint64(0)], np.cumsum(W.mixed(grams ^ _TWO)[order])])
    ends = np.searchsorted(segment[order], np.arange(count + 1))
    keys = _keys(sums[ends[1:]] - sums[ends[:-1]], band, np.arange(count))
    empty = ends[1:] == ends[:-1]
    if empty.sum() < over:
        keys[empty] = 0
    return keys


def neighbourhood(grams: np.ndarray, band: int, segment: int, p: int, q: int) -> np.ndarray:
    """Keys of the set in one segment, and of all sets of one n-gram less."""
    own = W.mixed(grams[_segment_of(grams, segments(band, p, q)[0]) == segment] ^ _TWO)
    sums = np.sum(own, dtype=np.uint64) - np.concatenate([[np.uint64(0)], own])
    return np.unique(_keys(sums, band, np.full(len(sums), segment + _CELL)))


def _band_of(size: int, p: int, q: int) -> int:
    return int(np.searchsorted(bands(p, q), size, "right")) - 1


def _packed_keys(keys: np.ndarray) -> bytes:
    return keys.view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES].tobytes()


def _profiles(n: int, p: int, q: int):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.large_binary(), pa.large_binary())
    names = ["id", "n", "d1", "d2", "band", "high", "low"]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for i, text in zip(batch.column("id").to_pylist(), bytes_of(batch, "text")):
                grams = ngram_hashes(text, n)
                band = _band_of(len(grams), p, q) if len(grams) else -1
                digests = [np.sum(W.mixed(grams ^ s), dtype=np.uint64).astype(np.int64) for s in (_ONE, _TWO)]
                high, low = (_packed_keys(entries(grams, b, p, q)) if b >= 0 else b"" for b in (band, band - 1))
                for column, value in zip(columns, (i, len(grams), *digests, band, high, low)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), names=names)

    return profile


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each entry of each document, in batches of bounded size."""
    for batch in batches:
        found, size = [], 0
        for i, band, *blocks in zip(*(batch.column(c).to_pylist() for c in ("id", "band", "high", "low"))):
            for b, block in zip((band, band - 1), blocks):
                raw = np.frombuffer(block, np.uint8).reshape(-1, _KEY_BYTES)
                keys = np.zeros((len(raw), 8), np.uint8)
                keys[:, :_KEY_BYTES] = raw
                keys = keys.view(np.int64).ravel()
                segment = np.flatnonzero(keys)
                found.append((keys[segment], b * _CELL + segment, np.full(len(segment), i)))
                size += len(segment)
            if size > 200_000:
                yield _index_rows(found)
                found, size = [], 0
        if size:
            yield _index_rows(found)


def _index_rows(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found)], names=["key", "cell", "id"]
    )


def _sets(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, bins, sizes = [], [], []
            for text in bytes_of(batch, "text"):
                grams = ngram_hashes(text, n)
                counts = np.bincount((W.mixed(grams) % np.uint64(BINS)).astype(np.int64), minlength=BINS)
                bins.append(np.minimum(counts, 255).astype(np.uint8).tobytes())
                out.append(grams.tobytes())
                sizes.append(len(grams))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(bins, pa.large_binary()), pa.array(out, pa.large_binary())],
                names=["id", "n", "bins", "grams"],
            )

    return sets


def _neighbourhoods(n: int, cells: list[tuple[int, int]], p: int, q: int):
    """Entries of the segments that allocation has chosen, with one n-gram less."""
    by_band: dict[int, list[int]] = {}
    for band, segment in cells:
        by_band.setdefault(band, []).append(segment)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), bytes_of(batch, "text")):
                grams = ngram_hashes(text, n)
                band = _band_of(len(grams), p, q) if len(grams) else -1
                for b in {band, band - 1} & by_band.keys():
                    for segment in by_band[b]:
                        keys = neighbourhood(grams, b, segment, p, q).view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys), pa.array(np.full(len(keys), b * _CELL + segment)), pa.array(np.full(len(keys), i))],
                            names=["key", "cell", "id"],
                        )

    return expand


def _verified(p: int, q: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist()):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(q * common >= p * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


def _plausible(p: int, q: int):
    """Pairs whose sizes and histograms don't rule a link out."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16)
                for c in ("bins_a", "bins_b")
            )
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            apart = np.abs(one - two).sum(1, dtype=np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(apart * (q + p) <= total * (q - p)))

    return check


def _links(pairs: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs ``a``, ``b`` whose sets are similar enough: compared by bounds, then whole."""
    brief = sets.select("id", "n", "bins")
    both = pairs.join(brief.toDF("a", "n_a", "bins_a"), "a").join(brief.toDF("b", "n_b", "bins_b"), "b")
    near = both.where(f"least(n_a, n_b) * {q} >= greatest(n_a, n_b) * {p}")
    near = written(map_batches(near.select("a", "b", "n_a", "n_b", "bins_a", "bins_b"), _plausible(p, q), "a long, b long"))
    whole = sets.select("id", "grams")
    both = near.join(whole.toDF("a", "one"), "a").join(whole.toDF("b", "two"), "b")
    return written(map_batches(both.select("a", "b", "one", "two"), _verified(p, q), "a long, b long"))


def _across(p: int, q: int):
    """Pairs of different components under one entry that their histograms don't rule out."""

    def closed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        _, left, right, chunk, ids, sizes, comps, bins = zip(*rows)
        chunk, ids, sizes, comps = (np.array(x, np.int64) for x in (chunk, ids, sizes, comps))
        bins = np.frombuffer(b"".join(bins), np.uint8).reshape(len(rows), BINS).astype(np.int16)
        one = np.flatnonzero(chunk == left[0])
        two = one if left[0] == right[0] else np.flatnonzero(chunk == right[0])
        a, b = [], []
        for k in one:
            other = two[(comps[two] != comps[k]) & ((two > k) | (left[0] != right[0]))]
            apart = np.abs(bins[other] - bins[k]).sum(1, dtype=np.int64)
            other = other[apart * (q + p) <= (sizes[other] + sizes[k]) * (q - p)]
            a += [int(ids[k])] * len(other)
            b += ids[other].tolist()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != unit:
                    yield from closed(rows)
                    unit, rows = row[:3], []
                rows.append(row)
        yield from closed(rows)

    return across


def _swaps(stats: DataFrame, sizes: DataFrame, p: int, q: int, row_cost: float) -> DataFrame:
    """``cell`` and ``role`` (skip, shrink) of the segments that aren't indexed whole.

    The k-th most expensive segment of a band is left out in exchange for the
    neighbourhood of the k-th cheapest, as long as its pairs cost more than the
    other's rows and pairs. A row for each segment of each band: bounded by the
    largest set, not by the number of documents.
    """
    spark = stats.sparkSession
    used = [(r["band"], r["n_docs"], r["n_grams"]) for r in sizes.collect()]  # a row for each band
    plan = []
    for band, docs, grams in used:
        if band >= 0 and (count := segments(band, p, q)[0]) > 1:
            plan.append((band, count, float(row_cost * (grams / count + docs))))
    cells = spark.createDataFrame(plan, "band int, m int, rows double")
    cells = cells.select("band", "m", "rows", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("segment"))
    cells = cells.withColumn("cell", F.col("band").cast("long") * _CELL + F.col("segment"))
    cost = cells.join(stats, "cell", "left").withColumn("cost", F.coalesce("pairs", F.lit(0.0)))
    ranked = cost.selectExpr(
        "band", "m", "rows", "cell", "cost",
        "row_number() OVER (PARTITION BY band ORDER BY cost DESC, cell) AS worst",
        "row_number() OVER (PARTITION BY band ORDER BY cost, cell DESC) AS best",
    )
    worst = ranked.where("2 * worst <= m").selectExpr("band", "worst AS k", "cell AS skipped", "cost AS saved")
    best = ranked.where("2 * best <= m").selectExpr("band", "best AS k", "cell AS shrunk", "rows + cost AS spent")
    swapped = worst.join(best, ["band", "k"]).where("saved > spent")
    return written(swapped.selectExpr("stack(2, skipped, 'skip', shrunk, 'shrink') AS (cell, role)"))


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ngram: int = NGRAM,
    threshold: tuple[int, int] = (P, Q),
    row_cost: float = 4.0,
) -> DataFrame:
    """``id``, ``n_grams`` and ``component`` of every row.

    Linked are texts whose sets of word n-grams have a Jaccard similarity of at
    least ``threshold`` (numerator, denominator); ``component`` is the smallest
    id reachable by links. ``row_cost``: what an index row costs beside a pair.

    Texts without words have no n-grams and are linked with nothing, as are rows
    without id. Ids must be whole numbers. Rows that share an id are one node.
    Other columns aren't carried along; they can be joined by id.
    """
    p, q = threshold
    base = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    base = base.withColumn("text", text_of())
    schema = "id long, n long, d1 long, d2 long, band int, high binary, low binary"
    keyed = written(map_batches(base, _profiles(ngram, p, q), schema))
    profiles = written(keyed.select("id", "n", "d1", "d2", "band"))
    nodes = profiles.where("n > 0 and id is not null")
    classes = written(nodes.groupBy("d1", "d2").agg(F.min("id").alias("rep")))
    reps = classes.select(F.col("rep").alias("id")).distinct()
    by_band = nodes.join(reps, "id", "left_semi").groupBy("band").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_grams"))
    entry = "key long, cell long, id long"

    def shared(rows: DataFrame) -> DataFrame:
        """Rows of keys that several rows have, copies of a set left out."""
        often = rows.groupBy("key").agg(F.count("*").alias("f")).where("f > 1")
        return written(rows.join(written(often.select("key")), "key").join(reps, "id", "left_semi").distinct())

    rows = shared(map_batches(keyed.where("n > 0 and id is not null").select("id", "band", "high", "low"), _index, entry))
    discard(keyed)
    stats = rows.groupBy("key").agg(F.first("cell").alias("cell"), F.count("*").alias("f"))
    stats = stats.groupBy("cell").agg(F.sum(F.expr("double(f) * (f - 1) / 2")).alias("pairs"))
    swaps = _swaps(stats, by_band, p, q, row_cost)
    shrunk = [(r["cell"] // _CELL, r["cell"] % _CELL) for r in swaps.where("role = 'shrink'").collect()]
    if shrunk:
        smaller = map_batches(
            base.where("id is not null").join(reps, "id", "left_semi"), _neighbourhoods(ngram, shrunk, p, q), entry
        )
        rows = rows.join(swaps, "cell", "left_anti").select("key", "cell", "id").union(shared(smaller).select("key", "cell", "id"))
    live = written(rows.groupBy("key").agg(F.count("*").alias("f"), F.min("id").alias("lead")).where("f > 1"))
    members = written(rows.select("key", "id").join(live, "key"))

    grouped = members.select("id").distinct()
    sets = written(map_batches(
        base.where("id is not null").join(grouped, "id", "left_semi"), _sets(ngram), "id long, n long, bins binary, grams binary"
    ))
    led = members.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = _links(led, sets, p, q)

    first = written(components(links))
    placed = members.join(first, "id", "left").withColumn("comp", F.coalesce("component", "id")).select("key", "id", "f", "comp")
    placed = written(placed)
    open_keys = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    parts = placed.join(written(open_keys.select("key")), "key")
    parts = parts.join(sets.select("id", "n", "bins"), "id").selectExpr(
        "key", "id", "n", "comp", "bins", f"(f + {BLOCK - 1}) div {BLOCK} AS chunks",
        f"pmod(xxhash64(id), (f + {BLOCK - 1}) div {BLOCK}) AS chunk",  # about BLOCK sets each, without ordering a hot key
    )
    units = parts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")).select(
        "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "id", "n", "comp", "bins"
    )
    units = units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "chunk", "id")
    pairs = map_batches(units, _across(p, q), "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = _links(pairs.distinct(), sets, p, q)

    final = components(links.union(more)).toDF("rep", "component")
    found = classes.join(final, "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component"))
    return (
        profiles.select("id", "n", "d1", "d2")
        .join(written(found), ["d1", "d2"], "left")
        .select(
            "id", F.col("n").alias("n_grams"),
            F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id")).alias("component"),
        )
    )
