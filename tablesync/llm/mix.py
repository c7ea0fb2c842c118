"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.frames import packed, written

#: A larger rate is inverted in parts of this size, each with a seed of its own.
PART = 500.0


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the 13 first hex digits of an MD5."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def source_rates(
    docs: DataFrame,
    source_col: str = "source",
    weights: Mapping[str, float] | None = None,
    power: float = 0.5,
    size: float = 1.0,
) -> DataFrame:
    """``source``, ``n_docs`` and ``rate``: the mean number of copies of a document.

    A source's share of the mixed corpus is proportional to its weight, or to its
    number of documents to ``power`` where no ``weights`` are given; a source
    without weight gets none. ``size`` is the mixed corpus in documents, as a
    multiple of the input. A missing source is a source of its own.
    """
    counts = docs.groupBy(docs[source_col].alias("source")).agg(F.count("*").alias("n_docs"))
    if weights is None:
        weight = F.pow(F.col("n_docs").cast("double"), F.lit(power))
    else:
        given = F.create_map(*(F.lit(x) for k, v in weights.items() for x in (k, float(v))))
        weight = F.coalesce(given[F.col("source")] if weights else F.lit(0.0), F.lit(0.0))
    counts = counts.withColumn("weight", weight)
    total = counts.agg(F.sum("weight").alias("weights"), F.sum("n_docs").alias("docs"))
    share = F.expr("CASE WHEN weights > 0 THEN weight / weights ELSE 0D END")
    return counts.join(F.broadcast(total)).select(  # one row
        "source", "n_docs", (share * F.col("docs") * F.lit(size) / F.col("n_docs")).alias("rate")
    )


def _boundaries(rate: Column) -> Column:
    """The distribution function of Poisson(rate) at 0, 1, ... until what is left is below 2**-53."""
    last = F.ceil(rate + F.lit(10.0) * F.sqrt(rate) + F.lit(20.0)).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("sums"))

    def step(done, k):
        p = done["p"] * rate / k
        return F.struct(
            p.alias("p"),
            F.concat(done["sums"], F.array(F.element_at(done["sums"], -1) + p)).alias("sums"),
        )

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda done: done["sums"])


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, with underscores where ``taken`` has them already."""
    out, used = [], {t.lower() for t in taken}
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def mix(
    docs: DataFrame,
    rates: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: int = 17,
) -> DataFrame:
    """``row``, ``copy`` (from 1) and ``mix_key``, in globally shuffled order.

    The number of copies inverts a Poisson distribution at a number hashed from
    seed and id, so repeating the job, or losing executors, changes nothing.
    Copies are dealt to partitions by a hash of ``mix_key`` and sorted by it
    there, so rows of one source or document spread over the whole output.

    Repeated rows of one id get equally many copies each. A row without id draws
    by its content and place in the input, so such rows don't live or die together.
    Rows of sources that ``rates`` lacks, or with rate 0, get no copy.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / F.lit(PART)).cast("int"))
    plan = rates.where("rate > 0").withColumn("parts", parts)
    plan = plan.select(
        "source", "parts", _boundaries(F.col("rate") / F.col("parts")).alias("sums")
    )
    plan = written(plan)
    base = packed(docs, id=id_col, source=source_col)
    place = F.concat_ws(":", F.lit("row"), F.xxhash64("row"), F.monotonically_increasing_id())
    base = base.withColumn("id", F.coalesce(F.col("id").cast("string"), place))
    joined = base.join(plan, base["source"].eqNullSafe(plan["source"]))
    copies = F.aggregate(
        F.sequence(F.lit(1), F.col("parts")),
        F.lit(0),
        lambda done, part: done
        + F.size(
            F.filter("sums", lambda s: s <= uniform(F.lit(seed), F.col("id"), part))
        ),
    )
    return (
        joined.withColumn("copies", copies)
        .where("copies > 0")
        .select("row", "id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("row", "copy", F.md5(F.concat_ws(":", F.lit(f"order{seed}"), F.col("id"), F.col("copy"))).alias("mix_key"))
        .repartition("mix_key")
        .sortWithinPartitions("mix_key")
    )
