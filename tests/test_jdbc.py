import uuid

from strata.sources.jdbc import load_tables, read_jdbc

DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_jdbc_replace_in_batches(spark):
    url = f"jdbc:derby:memory:strata{uuid.uuid4().hex[:8]};create=true"
    a = spark.range(12000).selectExpr("id", "cast(id * 2 as double) AS v")
    b = spark.range(3).selectExpr("id")
    status = load_tables({"T_A": a, "T_B": b, "T_MISSING": None}, url, batchsize=5000,
                         num_partitions=2, properties=DERBY)
    assert status == {"T_A": "loaded", "T_B": "loaded", "T_MISSING": "skipped"}
    assert read_jdbc(spark, url, "T_A", DERBY).count() == 12000
    # a second load replaces, not appends
    load_tables({"T_B": spark.range(7).selectExpr("id")}, url, properties=DERBY)
    assert read_jdbc(spark, url, "T_B", DERBY).count() == 7
