"""Plans of exact quantiles."""

from pyspark.sql import functions as F

from lodgecurve.operators import scale


def test_quantiles_of_one_column_need_no_long_form(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", None)], "k string, v double")
    out = scale.aggregate_with_quantiles(df, ["k"], [F.count(F.lit(1)).alias("n")], {"m": ("v", 0.5), "h": ("v", 0.9)})
    assert "explode" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert sorted(map(tuple, out.collect())) == [("a", 3, 1.0, 2.0), ("b", 1, None, None)]
