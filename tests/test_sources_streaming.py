"""Sources / sinks, ETL job and streaming entry points."""

import pytest
from pyspark.sql import functions as F

from veritab.plans.jobs import load_and_clean, run_etl
from veritab.sources import files
from veritab.streaming import monitor

CSV = """ loan_id , no_of_dependents, education, self_employed, income_annum, loan_amount, loan_term, cibil_score, residential_assets_value, commercial_assets_value, luxury_assets_value, bank_asset_value, loan_status
1,2, Graduate, No,9600000,29900000,12,778,2400000,17600000,22700000,8000000, Approved
2,0, Not Graduate, Yes,4100000,12200000,8,417,-100000,2200000,8800000,3300000, Rejected
"""


def test_read_csv_and_missing_path(spark, tmp_path):
    p = tmp_path / "loans.csv"
    p.write_text(CSV)
    df = files.read_csv(spark, str(p))
    assert df.count() == 2 and df.schema["cibil_score"].dataType.simpleString() == "bigint"
    with pytest.raises(FileNotFoundError):
        files.read_csv(spark, str(tmp_path / "absent.csv"))
    raw = files.read_monitoring_csv(spark, str(p))
    assert "loan_id" in raw.columns


def test_etl_job_writes_processed_table(spark, tmp_path):
    p = tmp_path / "loans.csv"
    p.write_text(CSV)
    out, report = run_etl(spark, str(p), str(tmp_path / "processed"))
    rows = out.orderBy("income_annum").collect()
    assert "loan_id" not in out.columns and len(rows) == 2
    assert rows[0]["residential_assets_value"] == 0 and rows[0]["education"] == "Not Graduate"
    assert sorted(r["loan_status"] for r in rows) == [0, 1]
    rep = {(r["metric"], r["column"]): r["value"] for r in report.collect()}
    assert rep[("negative_before", "residential_assets_value")] == 1.0
    df, model = load_and_clean(spark, str(p))
    assert list(model.labels) == ["Approved", "Rejected"] and df.count() == 2


def test_write_csv_and_json(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    files.write_table(df, str(tmp_path / "t_csv"), fmt="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "t_csv")).count() == 1
    files.write_report_json(df, str(tmp_path / "rep"))
    assert spark.read.json(str(tmp_path / "rep")).first()["s"] == "a"


def test_stream_validation_and_window_tvd(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame(
        [("2024-01-01 00:10:00", "a", 5.0), ("2024-01-01 00:20:00", "b", -1.0), ("2024-01-02 00:10:00", "a", 1.0), ("2024-01-05 00:00:00", "b", 2.0)],
        "ts string, kind string, amount double",
    ).withColumn("ts", F.to_timestamp("ts")).write.parquet(str(src))
    schema = spark.read.parquet(str(src)).schema
    stream = spark.readStream.schema(schema).parquet(str(src))
    from veritab.operators.validate import Rule

    rules = [Rule("amount:>=0", "amount", lo=0)]
    q = monitor.write_valid_and_quarantine(stream, rules, str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "ck1"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 3
    assert spark.read.parquet(str(tmp_path / "bad")).first()["violations"] == ["amount:>=0"]

    ref = spark.createDataFrame([("kind", "a", 0.5), ("kind", "b", 0.5)], "feature string, value string, r double")
    q2 = monitor.write_window_drift(spark.readStream.schema(schema).parquet(str(src)), "ts", ["kind"], ref,
                                    str(tmp_path / "tvd"), str(tmp_path / "ck2"))
    q2.awaitTermination(120)
    tvd = {str(r["window_start"])[:10]: r["score"] for r in spark.read.parquet(str(tmp_path / "tvd")).collect()}
    # Windows close once the watermark passes them; the last window stays open.
    assert tvd["2024-01-01"] == 0.0 and tvd["2024-01-02"] == 0.5


def test_etl_job_records_run(spark, tmp_path):
    from veritab.operators import history as H

    p = tmp_path / "loans.csv"
    p.write_text(CSV)
    store = H.RunStore(spark, str(tmp_path / "runs"))
    run_etl(spark, str(p), str(tmp_path / "processed"), store=store)
    runs = store.read(H.RUNS).collect()
    assert len(runs) == 1 and runs[0]["run_name"] == "etl" and runs[0]["tags"]["phase"] == "etl"
    m = {r["key"]: r["value"] for r in store.read(H.METRICS).collect()}
    assert m["rows_raw::*"] == 2.0 and m["duplicates::*"] == 0.0
    assert {r["key"] for r in store.read(H.PARAMS).collect()} == {"source", "output"}


def test_scoring_runs_on_a_stream(spark, tmp_path):
    from veritab.operators import ml as ML

    rows = [(float(i), "a" if i % 2 else "b", 1 if i % 2 else 0) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, c string, label int")
    model = ML.model_pipeline(ML.make_estimator("logistic_regression", {}, 40), ["x"], ["c"], 40).fit(df)
    src = tmp_path / "stream_in"
    df.drop("label").write.parquet(str(src))
    stream = spark.readStream.schema(df.drop("label").schema).parquet(str(src))
    q = ML.score(model, stream, keep=["x"]).writeStream.format("memory").queryName("scored").trigger(availableNow=True).start()
    q.awaitTermination(120)
    out = spark.sql("select * from scored")
    assert out.count() == 40 and set(out.columns) == {"x", "prediction", "approved", "probability", "label_text"}


def test_csv_columns_by_stripped_header_name(spark, tmp_path):
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

    from veritab.sources import files

    (tmp_path / "t.csv").write_text(" b , a,c\n 1.5 ,7, x\nbad,8,y\n,9,\n")
    schema = StructType([StructField("a", LongType()), StructField("b", DoubleType()), StructField("c", StringType())])
    rows = [tuple(r) for r in files.read_csv(spark, str(tmp_path / "t.csv"), schema).orderBy("a").collect()]
    assert rows == [(7, 1.5, " x"), (8, None, "y"), (9, None, None)]
    failed = {r["column"]: r["failed"] for r in files.cast_failures(spark, str(tmp_path / "t.csv"), schema).collect()}
    assert failed == {"a": 0, "b": 1}
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "t.csv"), StructType([StructField("zz", LongType())]))
