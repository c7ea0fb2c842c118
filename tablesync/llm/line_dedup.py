"""Line dedup: lines that several documents share stay in the first of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.frames import packed, text_of, written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ENDS = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z"  # "$" would also match before a last U+0085 or U+2028


def line_key(line: Column) -> Column:
    """The line without white space at its ends, in lower case (ASCII only)."""
    return F.translate(F.regexp_replace(line, _ENDS, ""), _UPPER, _LOWER)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 2,
    min_chars: int = 10,
) -> DataFrame:
    """``row``, ``kept_text``, ``n_lines`` and ``n_dropped`` of every row.

    A line whose key has at least ``min_chars`` code points and lies in at least
    ``min_docs`` documents stays only in the document with the smallest id.
    Lines are exploded with their positions and hashed to 128 bits; documents
    are counted per hash with partial aggregation, and the join back to the
    lines is one of two plain shuffles, so that Spark splits a hot line.
    Positions of dropped lines then meet the text of their document.

    Nulls and empty texts have one empty line. A text of which all lines are
    dropped becomes empty. Repeated rows of one id are treated alike.
    """
    base = packed(docs, id=id_col, text=text_col).withColumn("text", text_of())
    base = base.withColumn("version", F.xxhash64("text"))
    keyed = (
        base.where(F.col("id").isNotNull())
        .select("id", "version", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("id", "version", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(
            "id", "version", "pos",
            F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
        )
    )
    if min_docs <= 2:
        counted = keyed.groupBy("h1", "h2").agg(
            F.min("id").alias("first"), F.max("id").alias("last")
        )
        shared = counted.where("first < last") if min_docs == 2 else counted
    else:
        counted = keyed.select("h1", "h2", "id").distinct().groupBy("h1", "h2")
        shared = counted.agg(F.min("id").alias("first"), F.count("*").alias("n"))
        shared = shared.where(F.col("n") >= min_docs)
    shared = written(shared.select("h1", "h2", "first"))
    dropped = (
        keyed.join(shared, ["h1", "h2"])
        .where("id > first")
        .groupBy("id", "version")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    return (
        base.join(dropped, ["id", "version"], "left")
        .withColumn("lines", lines)
        .select(
            "row",
            F.when(F.col("dropped").isNull(), F.col("text"))
            .otherwise(F.array_join(F.transform(kept, lambda i: F.col("lines")[i]), "\n"))
            .alias("kept_text"),
            F.size("lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
