import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from veritab.llm import catalog, stages

from ..conftest import SF_SMALL
from .helpers import DOCS, frame, some_texts
from .test_jaccard import brute as classes
from .test_wumanber import brute as contaminated


def test_near_duplicates_keep_one_of_each_class(spark):
    texts = some_texts()
    out = stages.near_duplicates(spark, frame(spark, texts), SF_SMALL)
    want = {c for n, c in classes(texts, 5, 80).values()}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(want) and out.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f", None, None, None)] * 3 + [(None, "a b c d e f", None, None, None), (None, "q r s t u v", None, None, None), (None, None, None, None, None), (2, "", None, None, None)]
    out = stages.near_duplicates(spark, spark.createDataFrame(rows, DOCS), SF_SMALL).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in out) == [("1", "a b c d e f"), ("2", ""), ("None", ""), ("None", "q r s t u v")]


def test_decontamination_drops_hit_documents(spark):
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    texts = some_texts() + ["before " + bench[0][1] + " after", bench[1][1][: len(bench[1][1]) // 4]]
    out = {r["doc_id"] for r in stages.decontaminate(spark, frame(spark, texts), SF_SMALL).collect()}
    assert out == {i for i, v in contaminated(texts, bench).items() if not v[4]} and len(texts) - 2 not in out


def test_mix_repeats_by_taken_share(spark):
    rows = [(i, f"w{i} " * 40, None, "ab"[i % 2], None) for i in range(400)] + [(1000, None, None, "a", None)]
    out = stages.mix(spark, spark.createDataFrame(rows, DOCS), SF_SMALL)
    n = {r["source"]: r["n"] for r in out.where("doc_id < 1000").groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(n["a"] - 400 * 5 / 7) < 25 and abs(n["b"] - 400 * 2 / 7) < 25
    assert out.where("doc_id = 1000").count() == 1


@pytest.mark.parametrize("k", range(len(stages.STAGES)))
def test_stages_take_empty_tables_and_extra_columns(spark, k):
    name, stage = stages.STAGES[k]
    assert stage(spark, spark.createDataFrame([], DOCS), SF_SMALL).count() == 0
    df = frame(spark, ["some words in a text", None, "", "x " * 3000]).withColumn("__n", F.lit(1)).withColumn("label", F.lit("z"))
    out = stage(spark, df, SF_SMALL)
    assert out.count() >= 1
    if k < len(stages.STAGES) - 1:
        assert out.columns == df.columns


@pytest.mark.parametrize("k", range(len(stages.STAGES) - 1))
def test_stages_take_columns_named_like_their_own(spark, k):
    extra = ["keep", "tails", "expected_grade", "p_good", "class", "links", "fp", "root", "bands", "n_shingles", "hit_runs", "spans", "size", "taken", "target", "text_hash", "times", "shard", "slot", "h"]
    df = frame(spark, ["some words in a text", "other words in a text", None, ""])
    df = df.withColumns({c: F.lit(i) for i, c in enumerate(extra)})
    out = stages.STAGES[k][1](spark, df, SF_SMALL)
    rows = out.collect()
    assert out.columns == df.columns and rows and all(r[c] == i for r in rows for i, c in enumerate(extra))


def test_pipeline_runs_and_is_registered(spark):
    import __spark_entry__ as entry

    assert [n for n, _ in corpus_pipeline.STAGES] == [n for n, _ in stages.STAGES] and corpus_pipeline.ORACLE_SQL is None
    out = corpus_pipeline.run(spark, SF_SMALL)
    sizes = sorted(r["n"] for r in out.groupBy("shard").agg(F.count("*").alias("n")).collect())
    assert len(sizes) == 8 and sizes[-1] - sizes[0] <= 1
    names = entry.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
    assert set(catalog.ORACLES) <= set(entry.oracle_sql())
