from conftest import rows
from strata.operators.quality import audit_record, catalog, validation_counts
from strata.operators.validate import validate_keys


def test_validation_counts(spark):
    df = spark.createDataFrame([(0, None), (1, "a"), (2, "a"), (3, "b")], "seq long, k string")
    c = validation_counts(validate_keys(df, ["k"], ["seq"])).first()
    assert (c["original_rows"], c["valid_rows"], c["rejected_rows"], c["null_key_rows"],
            c["duplicate_key_rows"]) == (4, 2, 2, 1, 1)


def test_audit_record(spark):
    st = spark.createDataFrame([("ingestion", "success"), ("silver", "failed"),
                                ("gold", "upstream_failed")], "task_id string, state string")
    r = audit_record(st, "RUN_x", "2024-01-01 00:00:00", "2024-01-01 00:01:01.5").first()
    assert r["status"] == "FAILED"
    assert r["error_message"] == "Failed tasks: gold, silver"
    assert r["execution_seconds"] == 61.5
    ok = spark.createDataFrame([("ingestion", "success")], "task_id string, state string")
    r2 = audit_record(ok, "RUN_y", "2024-01-01 00:00:00", "2024-01-01 00:00:00").first()
    assert (r2["status"], r2["error_message"]) == ("SUCCESS", "")


def test_audit_schema_evolution(spark, tmp_dir):
    path = f"{tmp_dir}/audit"
    spark.createDataFrame([("1", "2")], "p string, q string").write.mode("append").parquet(path)
    spark.createDataFrame([("3", "4")], "q string, r string").write.mode("append").parquet(path)
    df = spark.read.option("mergeSchema", "true").parquet(path)
    assert sorted(df.columns) == ["p", "q", "r"]
    assert rows(df, "p", "q", "r") == [(None, "3", "4"), ("1", "2", None)]


def test_catalog(spark, tmp_dir):
    spark.range(5).write.parquet(f"{tmp_dir}/a")
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write("x\n1\n2\n")
    cat = catalog(spark, [("a", "silver", f"{tmp_dir}/a", "parquet"),
                          ("b", "raw", f"{tmp_dir}/b.csv", "csv")], as_of="2024-01-01 00:00:00")
    assert rows(cat, "dataset_name", "layer", "file_name", "file_format", "record_count") == [
        ("a", "silver", "a", "parquet", 5), ("b", "raw", "b.csv", "csv", 2)]


def test_catalog_splits_files_of_one_line_records(spark, tmp_dir):
    rows = spark.range(500).selectExpr("id", "concat('a, \"', id, '\"') as note")
    rows.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{tmp_dir}/c.csv")
    entries = [("c", "raw", f"{tmp_dir}/c.csv", "csv")]
    counts = [catalog(spark, entries, one_line=paths).first()["record_count"] for paths in ((), {f"{tmp_dir}/c.csv"})]
    assert counts == [500, 500]
