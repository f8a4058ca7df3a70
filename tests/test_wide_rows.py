"""Fits over wide rows: vectors are made once, long generated code is not left interpreted."""

from pyspark.sql import functions as F

from lodgecurve.operators import learning, scale


def wide(spark, n=400, width=70):
    columns = [(F.pmod(F.col("id") * (i + 3), F.lit(17)) / 17.0).alias(f"c{i}") for i in range(width)]
    return spark.range(0, n, 1, 3).select((F.col("id") / 400.0).alias("label"), *columns), [f"c{i}" for i in range(width)]


def test_vectors_are_made_once_for_a_fit(spark):
    rows, names = wide(spark)
    made = spark.sparkContext.accumulator(0)

    def counted(v):
        made.add(1)
        return v

    train = learning.assemble(rows.withColumn("c0", F.udf(counted, "double")("c0")), names)
    held = learning.fit_held(learning.boosted_trees(trees=3), train)
    assert made.value == 400
    plain = learning.boosted_trees(trees=3).fit(learning.assemble(rows, names))
    assert held.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]


def test_long_methods_are_not_left_interpreted(spark):
    before = spark.conf.get(scale.LONGEST_METHOD, None)
    try:
        spark.conf.unset(scale.LONGEST_METHOD)
        scale.compiled_rows(spark)
        assert spark.conf.get(scale.LONGEST_METHOD) == "8000"
        spark.conf.set(scale.LONGEST_METHOD, "20000")
        scale.compiled_rows(spark)
        assert spark.conf.get(scale.LONGEST_METHOD) == "20000"
    finally:
        spark.conf.unset(scale.LONGEST_METHOD)
        if before is not None:
            spark.conf.set(scale.LONGEST_METHOD, before)
