"""Stages of the corpus pipeline on awkward documents, and the whole run."""

from __future__ import annotations

import brute_llm
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copy int, mix_key string, row string, id string"
LONG = " ".join(f"long{k}" for k in range(40_000))


def documents(spark, n=12):
    texts = [None, "", "a shared line here\nown 1", "a shared line here\nown 2", "a shared line here", LONG, LONG + " end", "x", "x"]
    texts += [f"text number {k} has words of its own {k * k} and {k + 7} more" for k in range(n)]
    rows = [(k, t, "en" if k % 2 else None, "s" if k % 3 else None, len(t or ""), 1, "k", "r", "i") for k, t in enumerate(texts)]
    rows += [(None, "a shared line here", "en", "s", 1, None, None, None, None)] * 2 + [rows[2]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([("q1", "one two three"), ("q2", None)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES if s[0] not in ("toxicity", "mixing")], ids=lambda s: s[0])
def test_filtering_stages(spark, tables, stage):
    docs = documents(spark)
    kept = stage[1](spark, docs, tables)
    assert kept.columns == docs.columns
    rows = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert None in rows
    if stage[0] == "line dedup":
        plain = {i: t for i, _, gone, t in brute_llm.kept_lines([(r["doc_id"], r["text"]) for r in docs.collect()], 2, 10) if not gone or t.strip()}
        assert {i: t or "" for i, t in rows.items()} == plain
    elif stage[0] == "near copies":
        assert 6 not in rows and 5 in rows and 7 in rows and 8 not in rows
    else:
        assert len(rows) == docs.select("doc_id").distinct().count()
    assert stage[1](spark, docs.limit(0), tables).count() == 0


def test_mixing(spark, tables):
    docs = documents(spark)
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, tables)
    assert mixed.columns == [*docs.columns, "copy_", "mix_key_"]
    assert mixed.where("copy_ < 1 OR mix_key_ IS NULL").isEmpty()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), tables).count() == 0


def test_order_of_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near copies", "decontamination", "mixing"]
