"""Passes of order statistics over the values."""

from pyspark.sql import functions as F

from featloom.operators import order_stats


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_values_of_few_groups_are_not_moved_by_group(spark, monkeypatch):
    plans, write = {}, order_stats.materialize

    def seen(df, name="stage"):
        plans[name] = plan(df)
        return write(df, name)

    monkeypatch.setattr(order_stats, "materialize", seen)
    rows = spark.range(3000).select(F.concat(F.lit("c"), F.col("id") % 2).alias("column"), (F.col("id") * 7919 % 3001).cast("double").alias("value"))
    got = order_stats.robust_summary(rows, ["column"]).collect()
    assert "SortMergeJoin" not in plans["deviation-counts"]
    for r in got:
        held = sorted(x.value for x in rows.where(F.col("column") == r.column).collect())
        away = sorted(abs(x - r.median) for x in held)
        assert r.mad == (away[749] + away[750]) / 2 and r.mad_outliers == sum(x > 3 * r.mad for x in away)
