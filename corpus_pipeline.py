"""The corpus pipeline: five stages over documents, each on all that the one before it kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns the rows it keeps with the
columns of ``documents``; the last one adds ``copy`` and ``mix_key`` (with underscores
where documents have such columns). ``run`` writes
each stage to the shared folder and rereads it. Rows without id pass the stages
that compare documents; missing texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.decontaminate import find_benchmark
from tablesync.llm.frames import table, written
from tablesync.llm.jaccard_join import jaccard_components
from tablesync.llm.line_dedup import dedup_lines
from tablesync.llm.mix import free_names, mix, source_rates
from tablesync.llm.toxicity import fit_network, score_toxicity

MAX_TOXICITY = 0.5


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``MAX_TOXICITY``; the network learns from the labels of its input."""
    network = fit_network(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, network).where(F.col("score") < MAX_TOXICITY).select("row.*")


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of several documents stay in the first; documents that lose all their text go.

    Texts that change get their new length in ``n_chars``, where there is such a column.
    """
    kept = dedup_lines(docs).where("n_dropped = 0 OR trim(kept_text) <> ''")
    changed = F.col("n_dropped") > 0
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return kept.select(*(
        F.when(changed, new[c]).otherwise(F.col("row")[c]).alias(c) if c in new else F.col("row")[c].alias(c)
        for c in docs.columns
    ))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by shingles of five words: the smallest id."""
    found = jaccard_components(docs).where("id = component OR id IS NULL").select("id").distinct()
    found = written(found)
    return docs.join(found, docs["doc_id"].eqNullSafe(found["id"]), "left_semi")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    found = find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return found.where("NOT contaminated").select("row.*")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the target weights of their sources, in random order."""
    copy, key = free_names(docs.columns, "copy", "mix_key")
    return mix(docs, source_rates(docs)).select("row.*", F.col("copy").alias(copy), F.col("mix_key").alias(key))


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_shared_lines),
    ("near copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
]

#: A trained network decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return written(STAGES[-1][1](spark, docs, sf_dir))
