"""Exact quantiles against brute force, also with a group and a value that dominate."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loticote.operators import profiles, summary
from loticote.operators.summary import grouped_summary, largest, smallest, total

SHARES = {"q05": 0.05, "q25": 0.25, "mediane": 0.5, "q95": 0.95, "q00": 0.0, "q100": 1.0}


def brute(pdf):
    return pdf.groupby("g")["x"].quantile(list(SHARES.values())).unstack()


def check(spark, rows):
    df = spark.createDataFrame(rows, "g string, x double")
    got = grouped_summary(
        df.withColumn("y", F.col("x")), ["g"], "x", SHARES,
        {"low": smallest("y"), "high": largest("y"), "sum": total("y")}, count="n", mean="m",
    ).toPandas().set_index("g")
    pdf = pd.DataFrame(rows, columns=["g", "x"]).dropna()
    want = brute(pdf)
    for name, share in SHARES.items():
        np.testing.assert_allclose(got[name].sort_index(), want[share].sort_index(), rtol=1e-12)
    sizes = pdf.groupby("g")["x"].agg(["count", "min", "max", "mean"]).sort_index()
    got = got.sort_index()
    assert list(got["n"]) == list(sizes["count"])
    assert list(got["low"]) == list(sizes["min"]) and list(got["high"]) == list(sizes["max"])
    np.testing.assert_allclose(got["m"], sizes["mean"], rtol=1e-9)


def test_random_groups(spark):
    rng = random.Random(3)
    rows = [(f"g{rng.randint(0, 40)}", round(rng.lognormvariate(8, 2), 2)) for _ in range(20000)]
    check(spark, rows)


def test_hot_group_hot_value_and_signs(spark):
    rng = random.Random(4)
    rows = [("hot", 1234.5)] * 4000 + [("hot", round(rng.uniform(-500, 500), 2)) for _ in range(4000)]
    rows += [("one", 7.25), ("two", 1.0), ("two", 2.0), ("zero", 0.0), ("zero", 0.0)]
    rows += [("nulls", None), ("nulls", 3.0), (None, 9.0), ("same", 5.5), ("same", 5.5)]
    check(spark, [r for r in rows if r[0] is not None] + [])
    df = spark.createDataFrame(rows, "g string, x double")
    groups = grouped_summary(df, ["g"], "x", {"m": 0.5}).collect()
    assert None not in {r.g for r in groups}


def test_median_of_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "x double")
    assert summary.quantile(df, "x", 0.5, "m").first().m == 3.0


def test_trim_keeps_values_up_to_the_quantile(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("x"))
    kept = summary.trim_quantile(df, "x", 0.95)
    assert kept.count() == int((np.arange(1, 101) <= np.quantile(np.arange(1, 101), 0.95)).sum())


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert grouped_summary(df, ["g"], "x", {"m": 0.5}).count() == 0
    assert summary.trim_quantile(df, "x", 0.95).count() == 0


def test_histogram_matches_numpy(spark):
    rng = random.Random(5)
    data = [round(rng.gammavariate(2, 1000), 2) for _ in range(5000)] + [0.1 * i for i in range(300)]
    df = spark.createDataFrame([("a", x) for x in data], "g string, x double")
    counts, edges = np.histogram(data, bins=40)
    for build in (profiles.histogram, profiles.histogram_by_group):
        got = {r.classe: r.nb_annonces for r in build(df, "x", 40, "g").collect()}
        assert [got.get(i, 0) for i in range(40)] == list(counts)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 5.0)], "g string, x double")
    row = profiles.histogram(df, "x", 40, "g").first()
    assert (row.classe, row.nb_annonces) == (int(np.histogram([5.0, 5.0], 40)[0].argmax()), 2)


def test_shares_add_up(spark):
    df = spark.createDataFrame([(s,) for s in "aaabbc"] + [(None,)], "source string")
    got = {r.source: r.part for r in profiles.share(df, "source").collect()}
    assert got == {"a": 50.0, "b": 33.3, "c": 16.7}


def test_common_values(spark):
    groups = {"a": ["Be", "lome", None], "b": [" be", "agoe", None], "c": ["be", "be", "x"], None: ["lome"]}
    df = spark.createDataFrame([(s, z) for s, zs in groups.items() for z in zs], "source string, zone string")
    assert [r.zone for r in profiles.common_values(df, "zone", "source").collect()] == ["be"]


def test_many_distinct_values_in_one_cell(spark):
    """Values that lie closer together than a cell is wide are split again before they are ordered."""
    data = [1000 + i / 50_000 for i in range(400_000)]
    df = spark.range(400_000).selectExpr("'a' AS g", "1000 + id / 50000 AS x")
    assert df.select(summary.value_cell(F.col("x"))).distinct().count() == 1
    got = grouped_summary(df, ["g"], "x", {"m": 0.5, "p": 0.95}).first()
    assert (got.m, got.p) == pytest.approx((np.median(data), np.quantile(data, 0.95)), rel=1e-12)
    cells = df.withColumn("_cell", summary.value_cell(F.col("x")))
    sizes = cells.groupBy(summary.value_part(F.col("x"))).count().agg(F.max("count")).first()[0]
    assert sizes < 40_000


def test_rows_are_read_once(spark, tmp_path):
    """The counts of values serve parts and ordered values from one shuffle, so the input is read once."""
    rows = [(f"g{i % 3}", float(i % 7), float(i)) for i in range(200)] + [(None, 1.0, 1.0), ("g0", None, 2.0)]
    spark.createDataFrame(rows, "g string, x double, y double").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    got = grouped_summary(df, ["g"], "x", {"m": 0.5}, {"high": largest("y")}, count="n")
    assert len(got.collect()) == 3
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert "ReusedExchange" in final
