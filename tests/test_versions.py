"""Refreshes that fail, meet each other or replace each other; refusals, key guard, zone clustering."""

import json

import pytest
from pyspark.sql import functions as F
from test_batch import HEADER, LISTINGS, OFFICIAL, OFFICIAL_HEADER, write

from loticote.operators import dashboard, star
from loticote.plans import batch
from loticote.sources import versions, writers
from loticote.sources.schemas import RESULT_TABLES, STAR
from loticote.sources.versions import Refresh, committed, prune


def dims(spark, *names):
    rows = [(i, n, "", None, 0) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "id long, nom string, url string, date_collecte date, nombre_annonces int")


def failing(df):
    return df.withColumn("prix", F.raise_error(F.lit("stop")).cast("double"))


def test_a_refresh_that_fails_in_its_fifth_table_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "star")
    zones = spark.createDataFrame([(1, "be")], "id long, nom string")
    facts = {"zone_geographique": zones, "bien_immobilier": zones, "valeur_venale": zones, "annonce": zones}
    old = writers.refresh_star(spark, {"source_donnees": dims(spark, "a", "b"), **facts}, root)
    assert {r.table_name: r.nb_lignes for r in old.collect()} == {
        "source_donnees": 2, **dict.fromkeys(facts, 1), **dict.fromkeys(RESULT_TABLES, 0),
    }
    before = committed(spark, root)
    broken = {"source_donnees": dims(spark, "c"), **facts, "annonce": failing(zones)}
    assert list(broken).index("annonce") == 4
    with pytest.raises(Exception, match="stop"):
        writers.refresh_star(spark, broken, root)
    assert committed(spark, root) == before
    names = {r.nom for r in writers.read_star_table(spark, root, "source_donnees").collect()}
    assert names == {"a", "b"}
    assert len(list((tmp_path / "star" / versions.VERSIONS).iterdir())) == 1
    # The next refresh works, and readers of the old folders can go on.
    held = writers.read_star_table(spark, root, "source_donnees")
    writers.refresh_star(spark, {"source_donnees": dims(spark, "c")}, root)
    assert {r.nom for r in writers.read_star_table(spark, root, "source_donnees").collect()} == {"c"}
    assert held.count() == 2
    assert writers.read_star_table(spark, root, "zone_geographique").count() == 1


def test_two_refreshes_at_once(spark, tmp_path):
    root = str(tmp_path / "star")
    first, second = Refresh(spark, root), Refresh(spark, root)
    with first:
        first.write("t", spark.range(3))
    with pytest.raises(RuntimeError, match="another refresh"), second:
        second.write("t", spark.range(5))
    assert spark.read.parquet(committed(spark, root)["t"]).count() == 3


def test_counts_are_those_of_the_written_rows(spark, tmp_path):
    with Refresh(spark, str(tmp_path)) as new:
        odd = {"odd": F.count_if(F.col("id") % 2 == 1)}
        assert new.write("t", spark.range(11).repartition(3), counts=odd) == {"rows": 11, "odd": 5}
        assert new.write("empty", spark.range(0)) == {"rows": 0}
        assert new.write("none", spark.createDataFrame([], "p string, x int"), ["p"]) == {"rows": 0}


def test_prune_keeps_the_last_commits(spark, tmp_path):
    for n in range(4):
        with Refresh(spark, str(tmp_path)) as new:
            new.write("t", spark.range(n))
            if n == 0:
                new.write("kept", spark.range(7))
    prune(spark, str(tmp_path), keep=2)
    assert len(list((tmp_path / versions.COMMITS).glob("*.json"))) == 2
    tables = committed(spark, str(tmp_path))
    assert spark.read.parquet(tables["t"]).count() == 3 and spark.read.parquet(tables["kept"]).count() == 7
    assert len(list((tmp_path / versions.VERSIONS).iterdir())) == 3


def results(spark, rows):
    return spark.createDataFrame(rows, "id_zone long, type_bien string, periode string, prix_moyen_m2 double")


def test_results_of_other_periods_stay_and_refusals_are_counted(spark, tmp_path):
    root = str(tmp_path)
    first = results(spark, [(1, "Villa", "2023", 10.0), (1, "Villa", "2024", 11.0)])
    assert writers.write_results(spark, {"statistiques_zone": first}, root) == {
        "statistiques_zone": 2, "resultats_refuses": 0,
    }
    second = results(spark, [(2, "Villa", "2024", 12.0), (3, "Villa", "2024", 1e12), (4, "Villa", "2024", None)])
    counts = writers.write_results(spark, {"statistiques_zone": second}, root)
    assert counts == {"statistiques_zone": 2, "resultats_refuses": 1}
    stored = writers.read_star_table(spark, root, "statistiques_zone").collect()
    assert sorted((r.periode, r.id_zone) for r in stored) == [("2023", 1), ("2024", 2), ("2024", 4)]
    [row] = spark.read.parquet(committed(spark, root)["resultats_refuses"]).collect()
    assert (row.table_name, row.colonnes, json.loads(row.ligne)["id_zone"]) == ("statistiques_zone", "prix_moyen_m2", 3)


def test_names_with_one_key_stop_the_refresh(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    write(raw / "immoask.csv", HEADER, LISTINGS["immoask"])
    write(raw / "valeursvenales.csv", OFFICIAL_HEADER, OFFICIAL)
    batch.clean(spark, str(raw), out)
    batch.model(spark, out)
    before = committed(spark, f"{out}/etoile")
    monkeypatch.setattr(star, "dim_key", lambda name: F.length(name).cast("long") * 0)
    with pytest.raises(ValueError, match="'agoe' and 'keve' have the same key 0|same key 0"):
        batch.model(spark, out)
    assert committed(spark, f"{out}/etoile") == before


def scanned_rows(df):
    """Rows the scans of an executed plan have put out."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), 0
    stack = [plan]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            stack.append(node.plan())
        elif name == "FileSourceScanExec":
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return found


def test_a_zone_filter_reads_fewer_rows(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.concat(F.lit("zone "), F.col("id") % 40).alias("zone"), F.col("id").cast("string").alias("id")
    )
    loaded = rows.withColumn("id_zone", star.dim_key(F.col("zone"))).withColumn(star.SKIP_REASON, F.lit(None).cast("string"))
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    loaded.write.parquet(plain)
    with_files = star.cluster_by_zone(loaded.withColumn(star.SKIP_REASON, F.lit("x")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with_files.write.parquet(clustered)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    reads = {}
    for path in (plain, clustered):
        chosen = star.in_zone(spark.read.parquet(path), "zone 7")
        assert chosen.count() == 1000 and {r.zone for r in chosen.select("zone").distinct().collect()} == {"zone 7"}
        reads[path] = scanned_rows(chosen)
    assert reads[plain] == 40_000 and reads[clustered] <= 12_000


def test_listings_are_counted_from_statistics(spark):
    rows = [("be", "Villa", "VENTE", "GLOBAL", 10.0, 10.0, 5), ("be", "Villa", "VENTE", "GLOBAL", 10.0, 10.0, 5),
            ("be", "Studio", "VENTE", "GLOBAL", 20.0, 20.0, 2)]
    stats = spark.createDataFrame(rows, "zone string, type_bien string, type_offre string, periode string, "
                                  "prix_moyen_m2 double, prix_median_m2 double, nombre_annonces long")
    row = dashboard.kpis(stats).first()
    assert (row.biens_uniques, row.annonces_analysees, row.prix_median_m2) == (7, 12, 10.0)
    assert dashboard.kpis(stats, spark.range(9)).first().biens_uniques == 9
    assert set(STAR) >= set(RESULT_TABLES)


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    root = f"{tmp_path}/out/etoile"
    zones = spark.range(500).select(
        star.dim_key(F.concat(F.lit("z"), "id")).alias("id"), F.concat(F.lit("z"), "id").alias("nom")
    )
    # A third of all listings lies in one zone.
    number = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500)
    loaded = spark.range(6000).select(
        F.col("id").cast("string").alias("id"),
        star.dim_key(F.concat(F.lit("z"), number)).alias("id_zone"),
        F.lit(5.0).alias("prix_m2"),
        F.lit(None).cast("string").alias("zone"),
        F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("string").alias(star.SKIP_REASON),
    )
    with Refresh(spark, root) as new:
        writers.write_star(new, {"zone_geographique": zones})
        new.write("chargement", loaded)
    batch.store_buckets(spark, f"{tmp_path}/out", buckets=8, slices=4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = batch.bucketed_zone_view(spark, f"{tmp_path}/out")
        counts = {r.zone: r["count"] for r in view.groupBy("zone").count().collect()}
        view.collect()
        plan = view._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert sum(counts.values()) == 6000 and counts["z7"] >= 2000
