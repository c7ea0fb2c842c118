"""Benchmark decontamination: passages of test items found in one scan of each text."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.frames import bytes_of, discard, map_batches, packed, text_of, written

WINDOW = 13
#: Of distinct windows, which are the patterns; each byte takes a node of about 40 bytes at most in every worker.
MAX_AUTOMATON_BYTES = 8 << 20

#: Bytes that are not in a word become blanks, A-Z become a-z.
_FOLD = bytes(
    i + 32 if 0x41 <= i <= 0x5A else i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else 32
    for i in range(256)
)

_automata: dict[int, ahocorasick.Automaton] = {}


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """Runs of ``size`` words, or all words if there are fewer; blanks stand around each."""
    own = words(text)
    if not own:
        return []
    return [
        b" " + b" ".join(own[i : i + size]) + b" " for i in range(max(1, len(own) - size + 1))
    ]


def _automaton(patterns) -> ahocorasick.Automaton:
    """Built once for each broadcast and worker."""
    if patterns.id not in _automata:
        _automata.clear()
        built = ahocorasick.Automaton()
        for text, items in patterns.value:
            built.add_word(text, (len(text), items))
        built.make_automaton()
        _automata[patterns.id] = built
    return _automata[patterns.id]


class _Patterns:
    """A broadcast with a number of its own, by which workers remember the automaton."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    @property
    def value(self):
        return self.broadcast.value

    def __reduce__(self):
        return _loaded, (self.broadcast, self.id)


def _loaded(broadcast, number):
    patterns = _Patterns.__new__(_Patterns)
    patterns.broadcast, patterns.id = broadcast, number
    return patterns


def _scan(automaton: ahocorasick.Automaton, own: list[bytes]) -> tuple[list, set[str]]:
    """Inclusive word ranges of the occurrences, and the items they belong to."""
    line = (b" " + b" ".join(own) + b" ").decode("latin-1")
    found = [(end, *value) for end, value in automaton.iter(line)]
    if not found:
        return [], set()
    starts = np.cumsum([1] + [len(w) + 1 for w in own])  # of each word in the line
    first = np.searchsorted(starts, [end - length + 2 for end, length, _ in found])
    last = np.searchsorted(starts, [end for end, *_ in found]) - 1
    return list(zip(first.tolist(), last.tolist())), {i for *_, items in found for i in items}


def _scanner(patterns: _Patterns):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(patterns)
        for batch in batches:
            counts, all_hits, all_items = [], [], []
            before = zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist())
            for text, (hits, items) in zip(bytes_of(batch, "text"), before):
                own = words(text)
                ranges, found = _scan(automaton, own) if own and len(automaton) else ([], set())
                counts.append(len(own))
                all_hits.append(_merged([(h["first"], h["last"]) for h in hits] + ranges))
                all_items.append(sorted(found.union(items)))
            for name, values in (("n_words", counts), ("hits", all_hits), ("items", all_items)):
                at = batch.schema.get_field_index(name)
                batch = batch.set_column(at, name, pa.array(values, batch.schema.field(at).type))
            yield batch

    return scan


def _merged(ranges: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], last)
        else:
            out.append({"first": first, "last": last})
    return out


def _item_windows(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), bytes_of(batch, "text")):
                own = list(dict.fromkeys(windows(text, size)))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array([item] * len(own), pa.string())], names=["window", "item"])

    return cut


def _patterns(bench: DataFrame, size: int, max_bytes: int) -> Iterator[list[tuple[str, tuple[str, ...]]]]:
    """Distinct windows with their items, in parts of about ``max_bytes`` of windows and names of items each.

    Windows are cut, deduplicated and summed up in Spark and dealt to the parts
    by their hash. A part comes to the driver when it is asked for, so no more
    than the bound is there or broadcast at once; a larger benchmark takes
    several scans. Without windows there is one empty part.
    """
    cut = map_batches(bench, _item_windows(size), "window binary, item string")
    kept = written(cut.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items")))
    size_of = F.octet_length("window") + F.octet_length(F.array_join("items", ""))
    total = kept.agg(F.sum(size_of)).first()[0] or 0
    parts = -(-total // max_bytes) or 1
    for part in range(parts):
        own = kept.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == part).collect()
        if own or parts == 1:
            yield [(bytes(r["window"]).decode("latin-1"), tuple(r["items"])) for r in own]
    discard(kept)


def find_benchmark(
    docs: DataFrame,
    bench: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_automaton_bytes: int = MAX_AUTOMATON_BYTES,
) -> DataFrame:
    """``row``, ``n_words``, ``n_hit``, ``items``, ``spans`` and ``contaminated`` of every row.

    All windows of all items form one Aho-Corasick automaton, which passes over
    the folded text once; ``spans`` holds the character offsets of the hit runs
    in the original text. No shuffle: documents stay where they are read. Windows
    of more than ``max_automaton_bytes`` take an automaton and a scan for each
    part, and what is found so far is written in between, so that a worker has
    one automaton at a time.
    ``contaminated``: some word is hit, and hit words are a twentieth or more.

    Null and empty texts have no words. Items without words or without id match
    nothing; several items may share a window, and all of them are named.
    """
    items = bench.select(
        bench[item_col].cast("string").alias("item"),
        F.coalesce(bench[item_text_col], F.lit("")).alias("text"),
    ).where("item is not null")
    state = packed(docs, text=text_col).select(
        "row", text_of().alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<first:int,last:int>>)").alias("hits"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    sc = docs.sparkSession.sparkContext
    schema = state.schema
    scanned = before = None
    for part in _patterns(items, window, max_automaton_bytes):
        if scanned is not None:
            state = written(scanned)
            last.unpersist()
            if before is not None:
                discard(before)
            before = state
        last = sc.broadcast(part)
        scanned = map_batches(state, _scanner(_Patterns(last)), schema)
    state = scanned
    hit = map_batches(state, _located, _located_schema(schema))
    return hit.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def _located_schema(schema: T.StructType) -> T.StructType:
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    return T.StructType([
        schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(span)),
    ])


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hit words counted, and their ranges as offsets into the original text."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        hits = batch.column("hits").to_pylist()
        counts = [sum(h["last"] - h["first"] + 1 for h in own) for own in hits]
        texts = batch.column("text")
        spans = [_offsets(texts[i].as_py(), own) if own else [] for i, own in enumerate(hits)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("n_words"), pa.array(counts, pa.int64()), batch.column("items"), pa.array(spans, span)],
            names=["row", "n_words", "n_hit", "items", "spans"],
        )


def _offsets(text: str, hits: list[dict]) -> list[dict]:
    """Character offsets of word ranges; words are told apart as in :func:`words`."""
    blank = np.frombuffer(text.encode().translate(_FOLD), np.uint8) == 32
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    data = np.frombuffer(text.encode(), np.uint8)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters before each byte
    return [
        {"start": int(chars[edges[2 * h["first"]]]), "end": int(chars[edges[2 * h["last"] + 1]])}
        for h in hits
    ]
