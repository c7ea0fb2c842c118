"""Substring dedup: words covered by a window of words that also starts earlier are removed.

Every window gets a Rabin-Karp hash. Hashes travel packed: a task writes, for
each bucket of hashes, one block with its documents, positions and hashes, in
which a hash that the task has seen before is left out (the later window is
known to be a repeat, whatever other tasks hold). So a bucket gets a hash at
most once from each block, however many copies a passage has. Buckets find each
hash's first window; repeats travel back to their documents and merge there.

A second, independent hash tells windows apart that share the first: a task
compares all its bits, and what travels is its remainder, as the bucket, and
eight bits more, as a tag. Within a task 128 bits are compared, between tasks
72 and those that tell buckets apart: 88 in a corpus with 2**16 buckets or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm import words as W
from tablesync.llm.frames import bytes_of, map_batches, packed, text_of

WINDOW = 20
#: Windows that a task gathers before it writes its blocks, and that a bucket should hold.
BLOCK, BUCKET = 2_000_000, 3_000_000
#: Buckets that tasks deal windows to; with more, blocks would hold few windows. Beyond that, buckets are divided where they arrive.
DEALT = 1 << 16
#: Bytes of the texts that meet their repeats together.
MET = 1 << 27

_BASE, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SECOND = np.uint64(0x165667B19E3779F9)
_ROUTED = "bucket int, part int, kind int, id long, block binary, tags binary"
_MET = "bucket int, kind int, id long, block binary"


def window_hashes(values: np.ndarray, size: int, base: np.uint64 = _BASE) -> np.ndarray:
    """Polynomial hash modulo 2**64 of each run of ``size`` values, by differences of running sums."""
    if len(values) < size:
        return np.empty(0, np.uint64)
    powers = np.full(len(values), base)
    powers[0] = 1
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * np.cumprod(powers, dtype=np.uint64))])
    shifts = np.full(len(values) - size + 1, np.uint64(pow(int(base), -1, 1 << 64)))
    shifts[0] = 1
    return W.mixed((sums[size:] - sums[:-size]) * np.cumprod(shifts, dtype=np.uint64))


def _pack(ids: np.ndarray, pos: np.ndarray, hashes: np.ndarray | None = None) -> bytes:
    """Windows in order of document and position: runs of equal ids, gaps of positions, hashes."""
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    gaps = np.diff(pos, prepend=0)
    gaps[starts] = pos[starts]
    small = np.minimum(gaps, 255).astype(np.uint8)
    large = gaps[small == 255].astype(np.int64)
    head = np.array([len(ids), len(starts), len(large)], np.int64)
    lengths = np.diff(np.append(starts, len(ids))).astype(np.int32)
    packed_gaps = zstandard.compress(small.tobytes(), 1)
    parts = [head, np.array([len(packed_gaps)], np.int64), ids[starts].astype(np.int64), large, lengths]
    body = b"".join(p.tobytes() for p in parts) + packed_gaps
    return body + (hashes.tobytes() if hashes is not None else b"")


def _unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, runs, large, size = np.frombuffer(block, np.int64, 4).tolist()
    at = 32
    ids = np.frombuffer(block, np.int64, runs, at)
    at += 8 * runs
    long_gaps = np.frombuffer(block, np.int64, large, at)
    at += 8 * large
    lengths = np.frombuffer(block, np.int32, runs, at)
    at += 4 * runs
    small = np.frombuffer(zstandard.decompress(block[at : at + size]), np.uint8)
    at += size
    gaps = small.astype(np.int64)
    gaps[small == 255] = long_gaps
    sums = np.cumsum(gaps)
    starts = np.cumsum(lengths) - lengths
    before = np.repeat(sums[starts] - gaps[starts], lengths)
    hashes = np.frombuffer(block[at:], np.uint64) if at < len(block) else np.empty(0, np.uint64)
    return np.repeat(ids, lengths), sums - before, hashes


def _routed(bucket: int, part: int, kind: int, i: int, block: bytes, tags: bytes = b"") -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.large_binary(), pa.large_binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip((bucket, part, kind, i, block, tags), kinds)],
        names=["bucket", "part", "kind", "id", "block", "tags"],
    )


def _first_of_each(ids, pos, hashes, tags) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the windows that are the first with their hash and tag, and of those that are later.

    Windows of one document at one position (repeated rows) are not later than each other.
    """
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    later, extra = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
    if same.any():
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        own = order[shared]
        own = own[np.lexsort((pos[own], ids[own], tags[own], hashes[own]))]
        new = (hashes[own[1:]] != hashes[own[:-1]]) | (tags[own[1:]] != tags[own[:-1]])
        start = np.concatenate([[True], new])
        first = own[start][np.cumsum(start) - 1]
        later[own] = (ids[own] != ids[first]) | (pos[own] != pos[first])
        extra[own] = ~start
    return ~(later | extra), later


def _emit_windows(window: int, buckets: int, doc_buckets: int):
    def blocks(ids, pos, hashes, second) -> Iterator[pa.RecordBatch]:
        ids, pos, hashes, second = map(np.concatenate, (ids, pos, hashes, second))
        order = np.lexsort((pos, ids))
        ids, pos, hashes, second = ids[order], pos[order], hashes[order], second[order]
        first, later = _first_of_each(ids, pos, hashes, second)
        bucket, tags = second % np.uint64(buckets), (second >> np.uint64(56)).astype(np.uint8)
        place = np.argsort(np.where(first, bucket, buckets), kind="stable")
        ends = np.searchsorted(bucket[place][: first.sum()], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(ends)):
            own = place[ends[b] : ends[b + 1]]
            yield _routed(int(b), 0, 0, 0, _pack(ids[own], pos[own], hashes[own]), tags[own].tobytes())
        yield from _by_document(ids[later], pos[later], doc_buckets, kind=1, over=buckets)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), bytes_of(batch, "text")):
                values = W.hashes(text.split())
                own = window_hashes(values, window)
                if not len(own):
                    continue
                second = window_hashes(W.mixed(values ^ _SECOND), window, _OTHER)
                held.append((np.full(len(own), i, np.int64), np.arange(len(own), dtype=np.int64), own, second))
                n += len(own)
                if n >= BLOCK:
                    yield from blocks(*zip(*held))
                    held, n = [], 0
        if held:
            yield from blocks(*zip(*held))

    return emit


def _divide(parts: int):
    """Buckets that outgrow a task's memory, by hashes in parts that don't; the JVM sorts those, and spills."""

    def divided(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        buckets, blocks, tags = zip(*rows)
        ids, pos, hashes = map(np.concatenate, zip(*map(_unpack, blocks)))
        bucket, tags = np.repeat(buckets, [len(t) for t in tags]), np.frombuffer(b"".join(tags), np.uint8)
        part = ((hashes >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((pos, ids, part, bucket))
        new = (np.diff(bucket[order]) != 0) | (np.diff(part[order]) != 0)
        for own in np.split(order, np.flatnonzero(new) + 1):
            block = _pack(ids[own], pos[own], hashes[own])
            yield _routed(int(bucket[own[0]]), int(part[own[0]]), 0, 0, block, tags[own].tobytes())

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if parts == 1:
            yield from batches
            return
        held, n = [], 0
        for batch in batches:
            for bucket, _, kind, to, block, tags in zip(*(c.to_pylist() for c in batch.columns)):
                if kind:
                    yield _routed(bucket, 0, kind, to, block)
                    continue
                held.append((bucket, block, tags))
                n += len(tags)
                if n >= BLOCK:
                    yield from divided(held)
                    held, n = [], 0
        if held:
            yield from divided(held)

    return divide


def _document_bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return W.mixed(ids.astype(np.uint64)) % np.uint64(buckets)


def _by_document(ids, pos, buckets: int, kind: int, over: int = 0) -> Iterator[pa.RecordBatch]:
    """Windows to remove, in blocks for each bucket of documents.

    ``kind`` 1: on its way through the exchange of the hashes, spread ``over`` its buckets.
    """
    if not len(ids):
        return
    bucket = _document_bucket(ids, buckets)
    order = np.lexsort((pos, ids, bucket))
    ids, pos, bucket = ids[order], pos[order], bucket[order]
    ends = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    for b in np.flatnonzero(np.diff(ends)):
        own = slice(ends[b], ends[b + 1])
        to = (int(b) + int(ids[own][0])) % over if kind else int(b)
        yield _routed(to, 0, kind, int(b), _pack(ids[own], pos[own]))


def _find_repeats(doc_buckets: int):
    def closed(rows: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
        blocks, tags = zip(*rows)
        ids, pos, hashes = map(np.concatenate, zip(*map(_unpack, blocks)))
        _, later = _first_of_each(ids, pos, hashes, np.frombuffer(b"".join(tags), np.uint8))
        return ids[later], pos[later]

    def sent(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if found:
            yield from _by_document(*map(np.concatenate, zip(*found)), doc_buckets, kind=0)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, blocks, found = None, [], []
        for batch in batches:
            for bucket, part, kind, to, block, tags in zip(*(c.to_pylist() for c in batch.columns)):
                if (bucket, part) != at:
                    if blocks:
                        found.append(closed(blocks))
                    at, blocks = (bucket, part), []
                    if sum(len(ids) for ids, _ in found) >= BLOCK:
                        yield from sent(found)
                        found = []
                if kind:
                    yield _routed(to, 0, 0, 0, block)
                else:
                    blocks.append((block, tags))
        if blocks:
            found.append(closed(blocks))
        yield from sent(found)

    return find


def _keep_words(window: int):
    names = ["id", "n_words", "n_removed", "kept_text", "removed"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.large_string(),
             pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, found = None, []
        ids = pos = np.empty(0, np.int64)
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for bucket, kind, i, block in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at:
                    at, found, ids, pos = bucket, [], np.empty(0, np.int64), np.empty(0, np.int64)
                if kind == 0:
                    found.append(block)
                    continue
                if found:  # the texts of the bucket follow
                    ids, pos, _ = map(np.concatenate, zip(*map(_unpack, found)))
                    order = np.lexsort((pos, ids))
                    ids, pos, found = ids[order], pos[order], []
                own = zstandard.decompress(block).split()
                ranges = [] if i is None else _ranges(ids, pos, i, len(own), window)
                kept, last = [], 0
                for first, end in ranges:
                    kept += own[last:first]
                    last = end
                kept += own[last:]
                spans = [{"first": first, "end": end} for first, end in ranges]
                text = b" ".join(kept).decode()
                for column, value in zip(rows, (i, len(own), len(own) - len(kept), text, spans)):
                    column.append(value)
            if rows[0]:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, rows, kinds)), names=names)

    return keep


def _ranges(ids, pos, i: int, n_words: int, window: int) -> list[tuple[int, int]]:
    """Maximal word ranges under the windows of document ``i``."""
    starts = np.unique(pos[np.searchsorted(ids, i) : np.searchsorted(ids, i, "right")])
    starts = starts[starts + window <= n_words]
    if not len(starts):
        return []
    new = np.flatnonzero(np.diff(starts, prepend=starts[0] - 2 * window) > window)
    ends = starts[np.append(new[1:], len(starts)) - 1] + window
    return list(zip(starts[new].tolist(), ends.tolist()))


def _documents(buckets: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = bytes_of(batch, "text"), batch.column("id")
            spread = [len(t) if i is None else i for i, t in zip(ids.to_pylist(), texts)]
            bucket = _document_bucket(np.array(spread, np.int64), buckets)
            kind, blocks = np.ones(len(texts), np.int32), [zstandard.compress(t, 1) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket.astype(np.int32)), pa.array(kind), ids, pa.array(blocks, pa.large_binary())],
                names=["bucket", "kind", "id", "block"],
            )

    return pack


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``id``, ``n_words``, ``n_removed``, ``kept_text`` and ``removed`` (maximal word ranges) of every row.

    Other columns aren't carried along; they can be joined by id.

    A word goes if a window over it also starts earlier: in a smaller id, or
    earlier in the same document. Nulls, empty texts and texts shorter than the
    window keep all words. Ids must be whole numbers; rows without one are
    returned with all their words. Repeated rows of one id and text are treated
    alike; rows of one id with different texts count as one document.
    """
    spark = docs.sparkSession
    base = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    base = base.withColumn("text", text_of())
    known = base.where("id is not null")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    needed = -(-total // (5 * BUCKET))
    buckets = int(max(3 * parts, min(DEALT, needed)))
    doc_buckets = int(max(2 * parts, -(-total // MET)))

    windows = map_batches(known, _emit_windows(window, buckets, doc_buckets), _ROUTED)
    dealt = map_batches(windows.repartition(parts, "bucket"), _divide(int(max(1, -(-needed // buckets)))), _ROUTED)
    repeats = map_batches(dealt.sortWithinPartitions("bucket", "part"), _find_repeats(doc_buckets), _ROUTED)
    texts = map_batches(base, _documents(doc_buckets), _MET)
    met = repeats.drop("part", "tags").unionByName(texts).repartition(parts, "bucket")
    result = "id long, n_words long, n_removed long, kept_text string, removed array<struct<first:long,end:long>>"
    return map_batches(met.sortWithinPartitions("bucket", "kind"), _keep_words(window), result)
