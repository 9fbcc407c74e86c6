"""What keeps the work on listings in proportion to their rows: few shuffles, few sorts, code that is compiled."""

import pytest

from checks import views
from checks.views import PARAMS
from loticote.operators import cleaning, quality
from loticote.session import LISTING_SETTINGS, compiled_apart, tune, tune_listings

TABLES = {
    "lineitem": "SELECT 1L l_orderkey, 1L l_partkey, 1L l_suppkey, 1 l_linenumber, 1.0D l_quantity, 5000.0D l_extendedprice, 'F' l_linestatus",
    "orders": "SELECT 1L o_orderkey, '1-URGENT' o_orderpriority",
    "part": "SELECT 1L p_partkey, 'p' p_name, 'T' p_type, 50 p_size",
    "supplier": "SELECT 1L s_suppkey, 0 s_nationkey",
    "nation": "SELECT 0 n_nationkey, 'N' n_name",
}


@pytest.fixture
def tables(spark, tmp_path):
    for name, sql in TABLES.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield str(tmp_path)
    for key, value in kept.items():
        spark.conf.set(key, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_listings_are_shuffled_once_by_their_order(spark, tables):
    for df in (views.raw_listings(spark, tables), views.listings(spark, tables)):
        assert plan_of(df).count("hashpartitioning(l_orderkey") == 1
        assert df.count() == 1


def test_joins_are_compiled_apart_from_the_text_rules(spark, tables):
    tagged = cleaning.tag_listings(compiled_apart(views.raw_listings(spark, tables)), PARAMS)
    above = plan_of(tagged).split("CollectMetrics")
    assert len(above) == 2 and "Join" not in above[0] and "raison_rejet" not in above[1]
    assert [(r.zone, r.raison_rejet) for r in tagged.collect()] == [("n", None)]


def test_copies_are_sorted_by_a_hash_of_their_key_first(spark):
    rows = [("s", 1.0, 2), ("s", 1.0, 1), ("s", None, 3), (None, None, 4), ("s", float("nan"), 6), ("s", float("nan"), 5)]
    kept = quality.dedup(spark.createDataFrame(rows, "source string, prix double, n int"), ["source", "prix"])
    assert sorted(r.n for r in kept.collect()) == [1, 3, 4, 5]
    assert "Sort [_w0" in plan_of(kept) or "Sort [xxhash64" in plan_of(kept)


def test_settings_for_listings_end_with_the_next_tune(spark):
    before = {k: spark.conf.get(k, None) for k in LISTING_SETTINGS}
    tune_listings(spark)
    assert {k: spark.conf.get(k) for k in LISTING_SETTINGS} == LISTING_SETTINGS
    tune(spark)
    if not set(before.items()) & set(LISTING_SETTINGS.items()):
        assert {k: spark.conf.get(k, None) for k in LISTING_SETTINGS} == before
