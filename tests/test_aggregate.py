from conftest import rows
from strata.operators.aggregate import summarise


def test_null_group_keys_dropped_and_zero_sums(spark):
    df = spark.createDataFrame([("a", 1.0, "o1"), (None, 2.0, "o2"), ("b", None, None)],
                               "k string, x double, o string")
    out = summarise(df, ["k"], {"s": ("sum", "x"), "c": ("count", "x"), "d": ("nunique", "o")})
    assert rows(out, "k", "s", "c", "d") == [("a", 1.0, 1, 1), ("b", 0.0, 0, 0)]
