"""Files added to months that are stored."""

import pytest
from pyspark.sql import functions as F

from linktally.operators.rollup import RollupSpec, monthly_rollup
from linktally.plans.append import append_rollup
from linktally.sources.tables import read_by_month

SPEC = RollupSpec(keys=("k",), distinct={"n_users": "user", "n_posts": "post"}, carried={"link": "link"})
SCHEMA = "k string, month string, user string, post long, link string"
ROWS = [
    ("a", "2022-01", "u1", 1, "z"), ("a", "2022-01", "u1", 2, "y"), ("a", "2022-01", "u2", 2, None),
    (None, "2022-01", "u1", 3, "x"), ("b", "2022-02", None, None, None), ("a", None, "u9", 9, "w"),
    ("a", "2022-01", "u3", 4, "b"), ("a", "2022-01", "u1", 1, "z"), ("c", "2022-01", "u1", 5, "q"), ("a", "2022-02", "u1", 1, "z"),
]


@pytest.mark.parametrize("cut", [0, 3, 6, 10])
def test_appending_equals_a_full_run(spark, tmp_path, cut):
    df = spark.createDataFrame(ROWS, SCHEMA)
    full = monthly_rollup(df, SPEC)
    values, counts = str(tmp_path / "values"), str(tmp_path / "counts")
    months = ["2022-01", "2022-02"]
    for part in (ROWS[:cut], ROWS[cut:], ROWS[4:8]):  # the last are all known
        append_rollup(spark, spark.createDataFrame(part, SCHEMA), SPEC, months, values, counts)
    found = read_by_month(spark, counts, full.schema).select(*full.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, full.collect()))
    stored = spark.read.parquet(values)
    assert stored.count() == stored.distinct().count()


def test_only_new_values_are_written(spark, tmp_path):
    values, counts = str(tmp_path / "values"), str(tmp_path / "counts")
    append_rollup(spark, spark.createDataFrame(ROWS[:4], SCHEMA), SPEC, ["2022-01"], values, counts)
    before = set(spark.read.parquet(values).select(F.input_file_name().alias("f")).distinct().toPandas()["f"])
    append_rollup(spark, spark.createDataFrame([*ROWS[:4], ROWS[6]], SCHEMA), SPEC, ["2022-01"], values, counts)
    added = [r for r in spark.read.parquet(values).withColumn("f", F.input_file_name()).collect() if r["f"] not in before]
    assert sorted((r["measure"], r["value"]) for r in added) == [("link", "b"), ("n_posts", "4"), ("n_users", "u3")]
