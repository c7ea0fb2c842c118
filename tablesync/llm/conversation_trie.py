"""Prefix trie of conversations by peeling truncations.

Conversations are first rebuilt from turns (``rebuilt_turns``). A prefix is known
by its depth and two 64-bit sums of its turns, each hashed with its position, so a
running window over a conversation names all its prefixes without any text.

The trie is then peeled from its greatest depth upwards. At each depth the nodes
that survived from below, stripped of their last turn, meet the conversations that
end there; one grouping merges them into nodes and sums up what their subtrees
hold, so nodes are discovered and aggregated in the same pass. Equal conversations
are one row from the start.

``BAND`` depths are peeled after one shuffle: what shares a prefix at the lowest of
them meets there, and a worker peels one such group after the other. A group of
more than ``GROUP_STEPS`` turns (a first turn that many share) doesn't go to one
worker but is regrouped by Spark at each depth, by node and with partial sums.
Nodes carry the keys of their prefixes within the band only. Each band is written,
and the nodes of its lowest depth start the next; the root comes last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.frames import discard, map_batches, written

BAND = 64
#: Turns of one group, within a band, that a worker holds at once.
GROUP_STEPS = 250_000
#: Members of a node that are packed into one row before their digest is taken.
PACKED_IDS = 2000

GROUP, LENT = 5, 9  # a conversation takes fewer than LENT turns from the first of its GROUP


def _digest_half(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")


def _placed(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv``, ``pos`` from 1, digests and text size of every turn; texts stay where they are read."""
    who, said = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in (role, text))
    digest = F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said))
    rows = conversations.select(
        conversations[conv].cast("long").alias("conv"), conversations[turn].alias("turn"), who.alias("role"),
        _digest_half(digest, 1).alias("d1"), _digest_half(digest, 16).alias("d2"),
        F.octet_length(said).cast("long").alias("n_bytes"),
    )
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "d1", "d2")
    placed = rows.where("conv IS NOT NULL").withColumn("pos", F.row_number().over(order).cast("long"))
    return placed.drop("turn", "role")


def rebuilt_turns(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv``, ``size``, ``pos``, ``d1``, ``d2``, ``n_bytes``: the turns of rebuilt conversations.

    Conversation c has the first h turns of conversation c - c % 5, then its own
    turns after its first h, with h = crc32(c) % 9. Every conversation also has
    a row of position 0, also if it is left without turns. Turns are ordered by
    ``turn``, null first; equal ones by role, then by digest. Null roles and
    texts are empty; rows without conversation take no part.
    """
    turns = written(_placed(conversations, conv, turn, role, text))
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    taken = (F.crc32(F.col("conv").cast("string")) % LENT).alias("h")
    wanted = sizes.select("conv", "n", (F.col("conv") - F.col("conv") % GROUP).alias("donor"), taken)
    given = sizes.select(F.col("conv").alias("donor"), F.col("n").alias("donor_n"))
    plan = wanted.join(given, "donor", "left").withColumn("m", F.least("h", F.coalesce("donor_n", F.lit(0))))
    plan = written(plan.select("conv", "donor", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")))
    own = turns.join(plan, "conv").where("pos > h").withColumn("pos", F.expr("pos - h + m"))
    lent = turns.where(F.col("pos") < LENT).withColumnRenamed("conv", "donor").join(plan, "donor").where("pos <= h")
    none = F.lit(0).cast("long")
    roots = plan.select("conv", "size", *(none.alias(c) for c in ("pos", "d1", "d2", "n_bytes")))
    columns = roots.columns
    return own.select(columns).union(lent.select(columns)).union(roots)


def prefix_keys(turns: DataFrame) -> DataFrame:
    """``k1``, ``k2`` of the prefix that each turn ends, ``p1``, ``p2`` of the one before it."""
    until = Window.partitionBy("conv").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tags = [F.when(F.col("pos") > 0, F.xxhash64("pos", d)).otherwise(0) for d in ("d1", "d2")]
    tagged = turns.select("conv", "size", "pos", "n_bytes", *(t.alias(f"t{i}") for i, t in enumerate(tags, 1)))
    keyed = tagged.select("*", *(F.bit_xor(f"t{i}").over(until).alias(f"k{i}") for i in (1, 2)))
    before = (F.col(f"k{i}").bitwiseXOR(F.col(f"t{i}")).alias(f"p{i}") for i in (1, 2))
    return keyed.select("conv", "size", "pos", "n_bytes", "k1", "k2", *before)


_NODE = ["k1", "k2", "depth"]


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one node that follow each other, joined into rows of bounded size."""
    node, ids = None, []

    def closed() -> pa.RecordBatch:
        columns = [[v] for v in (*node, ids[0], len(ids), ",".join(map(str, ids)))]
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=[*_NODE, "conv", "n", "ids"])

    for batch in batches:
        for *own, conv in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "conv"))):
            if own != node or len(ids) == PACKED_IDS:
                if ids:
                    yield closed()
                node, ids = own, []
            ids.append(conv)
    if ids:
        yield closed()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each node: smallest member, members, digest of all their ids. Packs only stream through."""
    names, node, first, n, digest = [*_NODE, "conv", "n_convs", "ends"], None, None, 0, None
    done: list[tuple] = []

    def flushed() -> pa.RecordBatch:
        kinds = [pa.int64()] * 5 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    for batch in batches:
        for *own, conv, count, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "conv", "n", "ids"))):
            if own == node:
                digest.update(b",")
            else:
                if node:
                    done.append((*node, first, n, digest.hexdigest()))
                node, first, n, digest = own, conv, 0, hashlib.sha256()
            digest.update(ids.encode())
            n += count
        if done:
            yield flushed()
            done = []
    if node:
        done.append((*node, first, n, digest.hexdigest()))
        yield flushed()


def _classes(paths: DataFrame) -> DataFrame:
    """Equal conversations as one row: where they end, smallest id, number, digest of their ids.

    Ids are first packed in ranges, which split a large class over many tasks;
    what meets in one task then is its packed ids, and they pass through it.
    """
    ends = paths.where("pos = size").select("k1", "k2", F.col("size").alias("depth"), "conv")
    ranged = ends.repartitionByRange(*_NODE, "conv").sortWithinPartitions(*_NODE, "conv")
    packs = map_batches(ranged, _packs, "k1 long, k2 long, depth long, conv long, n long, ids string")
    dealt = packs.repartition(*_NODE).sortWithinPartitions(*_NODE, "conv")
    return map_batches(dealt, _digests, "k1 long, k2 long, depth long, conv long, n_convs long, ends string")


_SUMS = ["n_convs", "n_children", "n_leaves", "saved"]
_STATE = ["conv", *_SUMS, "ends"]
_NODES = ["depth", "k1", "k2", *_STATE, "p1", "p2"]
_NODE_KIND = (
    "depth long, k1 long, k2 long, conv long, n_convs long, n_children long, n_leaves long, saved long, ends string, p1 long, p2 long"
)


def _entering(n_children: int, ends: Column) -> list[Column]:
    """What conversations (0) or surviving nodes (1) bring to the depth at which they are grouped."""
    zero = F.lit(0).cast("long")
    sums = [F.col(c) if n_children else zero.alias(c) for c in ("n_leaves", "saved")]
    return [F.col("conv"), F.col("n_convs"), F.lit(n_children).cast("long").alias("n_children"), *sums, ends.alias("ends")]


def _ended() -> list[Column]:
    return _entering(0, F.col("ends"))


def _surviving() -> list[Column]:
    return _entering(1, F.lit(None).cast("string"))


def _regrouped(rows: DataFrame, depth: int) -> DataFrame:
    """Rows that stand at ``depth`` merged into its nodes, by Spark."""
    last = F.element_at("path", -1)
    nodes = rows.select(last["k1"].alias("k1"), last["k2"].alias("k2"), "*").groupBy("k1", "k2").agg(
        F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in _SUMS), F.max("ends").alias("ends"),
        *(F.any_value(c).alias(c) for c in ("path", "q1", "q2")),
    )
    above = F.when(F.size("path") > 1, F.get("path", F.size("path") - 2))
    return nodes.select(
        F.lit(depth).cast("long").alias("depth"), "k1", "k2", "conv", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * last["n_bytes"]).alias("saved"), "ends",
        *(F.coalesce(above[f"k{i}"], F.col(f"q{i}")).alias(f"p{i}") for i in (1, 2)), "path", "q1", "q2",
    )


def _by_depth(rows: DataFrame, lowest: int, highest: int) -> DataFrame | None:
    """The nodes of large groups: a grouping and a written table for each depth."""
    nodes, above = None, None
    for depth in range(highest, lowest - 1, -1):
        here = rows.where(F.size("path") == depth - lowest + 1).drop("b1", "b2")
        if above is not None:
            stripped = F.slice("path", F.lit(1), F.size("path") - 1).alias("path")
            here = here.unionByName(above.select(*_surviving(), stripped, "q1", "q2"))
        above = written(_regrouped(here, depth))
        nodes = above.select(_NODES) if nodes is None else nodes.union(above.select(_NODES))
    return nodes


def _peeled(lowest: int):
    """The nodes of groups that follow each other, each peeled as a whole."""

    def peel(group: list[tuple]) -> Iterator[tuple]:
        entering: dict[int, list[tuple]] = {}
        for row in group:
            entering.setdefault(len(row[6]), []).append(row)
        alive: dict[tuple[int, int], list] = {}
        for size in range(max(entering), 0, -1):
            stripped = ((n[0], n[1], 1, n[3], n[4], None, *n[6:]) for n in alive.values())
            merged: dict[tuple[int, int], list] = {}
            for row in (*entering.get(size, ()), *stripped):
                key = row[6][size - 1], row[7][size - 1]
                node = merged.get(key)
                if node is None:
                    merged[key] = list(row)
                else:
                    node[0] = min(node[0], row[0])
                    for k in (1, 2, 3, 4):
                        node[k] += row[k]
                    node[5] = node[5] or row[5]
            for (k1, k2), node in merged.items():
                conv, convs, children, leaves, saved, ends, ones, twos, n_bytes, q1, q2 = node
                node[3] = leaves = leaves if children else 1
                node[4] = saved = saved + (convs - 1) * n_bytes[size - 1]
                parent = (ones[size - 2], twos[size - 2]) if size > 1 else (q1, q2)
                yield (lowest + size - 1, k1, k2, conv, convs, children, leaves, saved, ends, *parent)
            alive = merged

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string() if c == "ends" else pa.int64() for c in _NODES]
        columns = [*_STATE, "ones", "twos", "sizes", "q1", "q2"]
        group, at, done = [], None, []

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=_NODES)

        for batch in batches:
            own = zip(*(batch.column(c).to_pylist() for c in ("b1", "b2")))
            for key, *row in zip(own, *(batch.column(c).to_pylist() for c in columns)):
                if key != at and group:
                    done += peel(group)
                    group = []
                    if len(done) > 20_000:
                        yield flushed()
                        done = []
                at = key
                group.append(tuple(row))
        if group:
            done += peel(group)
        if done:
            yield flushed()

    return run


def _band_nodes(rows: DataFrame, lowest: int, highest: int, group_steps: int) -> DataFrame:
    """All nodes of the depths from ``lowest`` to ``highest``; ``rows`` is a written table."""
    sizes = rows.groupBy("b1", "b2").agg(F.sum(F.size("path")).alias("steps"))
    large = written(sizes.where(F.col("steps") > group_steps).select("b1", "b2"))
    if large.isEmpty():
        small, nodes = rows, None
    else:
        small = rows.join(large, ["b1", "b2"], "left_anti")
        nodes = _by_depth(rows.join(large, ["b1", "b2"], "left_semi").select(rows.columns), lowest, highest)
    parts = (F.col(f"path.{f}").alias(n) for f, n in (("k1", "ones"), ("k2", "twos"), ("n_bytes", "sizes")))
    flat = small.select("b1", "b2", *_STATE, *parts, "q1", "q2")
    flat = flat.repartition("b1", "b2").sortWithinPartitions("b1", "b2")
    peeled = map_batches(flat, _peeled(lowest), _NODE_KIND)
    return peeled if nodes is None else peeled.union(nodes)


def prefix_trie(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    group_steps: int = GROUP_STEPS,
) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations (``rebuilt_turns``).

    ``conv`` (smallest member), ``depth``, ``parent`` (smallest member of the
    parent, null for the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless
    nodes below and including it), ``saved`` (over its subtree, members but one
    times the bytes of a node's last text) and ``ends`` (SHA-256 of the ids of the
    members that end there, ascending, joined by commas; of nothing if none).

    An empty table has no node, conversations without turns are members of the
    root. Turns are compared by 120 bits of a digest. Other columns are ignored.
    """
    paths = written(prefix_keys(rebuilt_turns(conversations, conv, turn, role, text)))
    classes = written(_classes(paths))
    band_of = F.floor((F.col("pos") - 1) / BAND)
    owned = paths.where("pos > 0").join(classes.select("conv"), "conv", "left_semi").withColumn("band", band_of)
    slices = owned.groupBy("conv", "band").agg(
        F.sort_array(F.collect_list(F.struct("pos", "k1", "k2", "n_bytes"))).alias("path"),
        *(F.min_by(f"p{i}", "pos").alias(f"q{i}") for i in (1, 2)),
    )
    slices = written(slices, "band")
    ended = classes.where("depth > 0").withColumn("band", F.floor((F.col("depth") - 1) / BAND)).join(slices, ["conv", "band"])
    ended = written(ended.select("band", *_ended(), "path", "q1", "q2"), "band")
    deepest = classes.agg(F.max("depth")).first()[0]

    bands, live = [], None
    for band in range(-1 if deepest is None else (deepest + BAND - 1) // BAND - 1, -1, -1):
        lowest, highest = band * BAND + 1, min(deepest, band * BAND + BAND)
        rows = ended.where(F.col("band") == band).drop("band")
        if live is not None:
            own = slices.where(F.col("band") == band).drop("band")
            rows = rows.unionByName(live.select(_surviving()).join(own, "conv"))
        bottom = F.get("path", F.lit(0))
        rows = written(rows.select(bottom["k1"].alias("b1"), bottom["k2"].alias("b2"), "*"))
        bands.append(written(_band_nodes(rows, lowest, highest, group_steps)))
        discard(rows)
        live = bands[-1].where(F.col("depth") == lowest)
    root = classes.where("depth = 0").select(_ended())
    if live is not None:
        root = root.union(live.select(_surviving()))
    root = root.agg(F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in _SUMS), F.max("ends").alias("ends"))
    zero = F.lit(0).cast("long")
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).alias("n_leaves")
    nodes = root.where("conv IS NOT NULL").select(
        *(zero.alias(c) for c in ("depth", "k1", "k2")), "conv", "n_convs", "n_children", leaves, "saved", "ends",
        *(zero.alias(c) for c in ("p1", "p2")),
    )
    for band in bands:
        nodes = nodes.union(band)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent"))
    named = nodes.join(parents, ["depth", "p1", "p2"], "left")
    for table in (paths, slices, ended):
        discard(table)
    return named.select("conv", "depth", "parent", *_SUMS, F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends"))
