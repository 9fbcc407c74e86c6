"""Star schema, gap to official values, price index, dashboard."""

from pyspark.sql import functions as F

import checks.star_queries  # noqa: F401
from checks.registry import QUERIES
from loticote.operators import cleaning, dashboard, index, profiles, quality, star, statistics
from loticote.sources.schemas import LISTING

ROWS = [
    ("t1", "VENTE", "Villa", "be", 1000.0, "3.0", 2.0, "immoask"),
    ("t2", "vente ", "chambres", "bè", 3000.0, None, 2.0, "facebook"),
    ("t3", "LOCATION", None, "be", 100.0, "x", 0.0, "immoask"),
    ("t4", None, "l'ecole/bar", "lome", 100.0, "1.2.3", 1.0, "immoask"),
    ("t5", "VENTE", "Villa", "nan", 100.0, "1", 1.0, "immoask"),
    ("t6", "VENTE", "Villa", "be", 100.0, "1", 1.0, None),
    ("t7", "VENTE", "Villa", "be", 1e14, "1", 1.0, "immoask"),
]


def listings(spark):
    schema = "titre string, type_offre string, type_bien string, zone string, prix double, " \
             "pieces string, surface_m2 double, source string"
    return spark.createDataFrame(ROWS, schema)


def test_dimensions(spark):
    df = listings(spark)
    assert {r.nom for r in star.dim_source(df).collect()} == {"ImmoAsk", "Facebook", "ValeursVenales"}
    zones = star.dim_zone(df)
    assert {r.nom for r in zones.collect()} == {"be", "bè", "lome"}
    assert zones.select("id").distinct().count() == 3


def test_loaded_and_skipped_cover_the_input(spark):
    df = listings(spark)
    zones, sources = star.dim_zone(df), star.dim_source(df)
    loaded = star.load_listings(df, zones, sources)
    rows = {r.titre: r for r in loaded.collect()}
    assert set(rows) == {"t1", "t2", "t3"}
    assert (rows["t1"].prix_m2, rows["t1"].pieces, rows["t1"].type_bien) == (500.0, 3, "Villa")
    assert (rows["t2"].type_bien, rows["t2"].type_offre) == ("Chambre", "VENTE")
    assert (rows["t3"].prix_m2, rows["t3"].type_bien) == (None, "Inconnu")
    skipped = {r.raison_ignore: r.nb_lignes for r in star.load_skipped(df, zones, sources).collect()}
    assert skipped == {
        "chargee": 3, "zone_inconnue": 1, "source_inconnue": 1, "pieces_invalides": 1,
        "valeur_hors_bornes": 1,
    }
    assert sum(skipped.values()) == len(ROWS)


def test_views_and_pairs(spark):
    df = listings(spark)
    zones, sources = star.dim_zone(df), star.dim_source(df)
    loaded = star.load_listings(df, zones, sources)
    view = star.listing_view(loaded, zones, sources).collect()
    assert {(r.titre, r.zone, r.source) for r in view} == {("t1", "be", "ImmoAsk"), ("t2", "bè", "Facebook")}
    pairs = star.pair_listings(star.fact_listing(loaded), star.dim_property(loaded))
    assert pairs.count() == loaded.count()
    counts = {r.source: r.nombre_annonces for r in star.listings_per_source(sources, loaded).collect()}
    assert counts == {"ImmoAsk": 2, "Facebook": 1, "ValeursVenales": 0}


def test_listing_key_keeps_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("", "a"), ("a", "")], "x string, y string")
    keys = df.select(star.listing_key(F.col("x"), F.col("y")).alias("k")).distinct()
    assert keys.count() == 4


def official(spark, *rows):
    schema = "zone string, prefecture string, prix double, surface_m2 double, prix_m2_officiel double"
    return spark.createDataFrame(list(rows), schema)


def test_official_zones_resolve_by_name_then_by_accent(spark):
    listed = star.dim_zone(listings(spark).where("zone <> 'bè'"))
    values = official(
        spark, ("be", "P", 600.0, 1.0, 10.0), ("bé", "Q", 600.0, 1.0, 20.0),
        ("agoe", "Q", 600.0, 1.0, 30.0), ("agoe", "P", 600.0, 1.0, 40.0),
    )
    zones = star.upsert_zones(listed, values)
    assert {(r.nom, r.prefecture) for r in zones.collect()} == {
        ("be", "GOLFE"), ("lome", "GOLFE"), ("bé", "Q"), ("agoe", "P"),
    }
    names = zones.select(F.col("id").alias("id_zone"), "nom")
    fact = star.fact_official(values, zones, listed).join(names, "id_zone")
    assert sorted((r.prix_m2_officiel, r.nom) for r in fact.collect()) == [
        (10.0, "be"), (20.0, "be"), (30.0, "agoe"), (40.0, "agoe"),
    ]


def test_unmatched(spark):
    df = listings(spark)
    dim = star.dim_zone(df.where("zone = 'be'"))
    assert [r.zone for r in quality.unmatched(df, dim, "zone", limit=2).collect()] == ["bè", "lome"]


def test_reject_widths(spark):
    row = ("t" * 300, "o" * 60, "b" * 150, "z" * 300, 1.0, 1, 1.0, "s" * 150)
    df = spark.createDataFrame([row], LISTING).withColumn("raison_rejet", F.lit("r" * 150))
    got = star.rejects_table(df).first()
    widths = [len(got[c]) for c in ("titre", "zone", "type_bien", "type_offre", "source", "raison_rejet")]
    assert widths == [255, 255, 100, 50, 100, 100]


def test_statistics_and_gap(spark):
    view = spark.createDataFrame(
        [("be", "Villa", "VENTE", p, p / 2) for p in (2.0, 4.0, 8.0, 20.0)]
        + [("be", "Villa", "VENTE", 5.0, None), ("be", "Villa", "VENTE", 5.0, 0.0)],
        "zone string, type_bien string, type_offre string, prix double, prix_m2 double",
    )
    stats = statistics.zone_stats(view)
    row = stats.first()
    assert (row.prix_moyen_m2, row.prix_median_m2, row.prix_min, row.prix_max, row.nombre_annonces,
            row.periode) == (4.25, 3.0, 2.0, 20.0, 4, "GLOBAL")
    values = official(spark, ("be", "P", 1.0, 1.0, 2.0), ("be", "P", 1.0, 1.0, 4.0))
    gaps = [r.ecart_valeur_venale for r in statistics.official_gap(stats, values).collect()]
    assert sorted(gaps) == [6.25, 112.5]
    mean = statistics.official_gap(stats, values, aggregate=True).collect()
    assert [r.ecart_valeur_venale for r in mean] == [41.67]


def two_offers(spark):
    return spark.createDataFrame(
        [("be", "Villa", "VENTE", "GLOBAL", 100.0), ("be", "Villa", "LOCATION", "GLOBAL", 10.0)],
        "zone string, type_bien string, type_offre string, periode string, prix_moyen_m2 double",
    )


def test_index_key(spark):
    stats = two_offers(spark)
    every = [r.indice_valeur for r in index.price_index(stats).collect()]
    assert sorted(every) == [10.0, 100.0, 100.0, 1000.0]
    own = index.price_index(stats, index.ZONE_TYPE_OFFER).collect()
    assert [(r.indice_valeur, r.tendance) for r in own] == [(100.0, "STABLE")] * 2


def test_index_without_reference_is_stable_and_not_stored(spark):
    stats = two_offers(spark).withColumn("periode", F.lit("2024"))
    prices = index.price_index(stats)
    assert [r.tendance for r in prices.collect()] == ["STABLE", "STABLE"]
    assert index.storable_index(prices).count() == 0


def test_index_against_the_oldest_period(spark):
    stats = spark.createDataFrame(
        [("be", "Villa", "VENTE", "2023", 100.0), ("be", "Villa", "VENTE", "2024", 120.0),
         ("agoe", "Villa", "VENTE", "2024", 50.0)],
        "zone string, type_bien string, type_offre string, periode string, prix_moyen_m2 double",
    )
    got = index.price_index(stats, index.ZONE_TYPE_OFFER, reference=None).collect()
    assert {(r.zone, r.periode): r.indice_valeur for r in got} == {
        ("be", "2023"): 100.0, ("be", "2024"): 120.0, ("agoe", "2024"): None,
    }


def test_accents_are_one_group_in_the_type_index(spark):
    view = spark.createDataFrame(
        [("be", "Villa", "VENTE", 10.0), ("bè", "Villa", "VENTE", 20.0), ("lome", "Villa", "VENTE", 1.0)],
        "zone string, type_bien string, type_offre string, prix_m2 double",
    )
    rows = statistics.index_by_type_zone(view).collect()
    assert [(r.zone_nom, r.prix_moyen_m2, r.nb_annonces) for r in rows] == [("be", 15.0, 2)]


def test_filters(spark):
    df = spark.createDataFrame(
        [("be", "Villa", "VENTE"), ("be", "Loft", "VENTE"), ("lome", "Villa", "LOCATION")],
        "zone string, type_bien string, type_offre string",
    )
    assert dashboard.apply_filters(df).count() == 3
    assert dashboard.apply_filters(df, zone="be", types=["Villa"], offer="VENTE").count() == 1
    assert dashboard.apply_filters(df, types=["Villa"]).count() == 2


def test_map_uses_both_spellings(spark):
    stats = spark.createDataFrame(
        [("be", 10.0), ("bè", 1234567.0), ("nulle part", 5.0)], "zone string, prix_moyen_m2 double"
    )
    points = {r.zone: r for r in dashboard.map_points(stats).collect()}
    assert set(points) == {"be", "bè"}
    assert points["be"].couleur == "#00ff33"
    assert points["bè"].legende == "Bè - 1,234,567 FCFA/m2"


def test_kpis(spark):
    stats = spark.createDataFrame(
        [("be", 10.0, 8.0, 3), ("be", 20.0, 12.0, 1), ("lome", 30.0, 20.0, 2)],
        "zone string, prix_moyen_m2 double, prix_median_m2 double, nombre_annonces int",
    )
    row = dashboard.kpis(stats, spark.range(5)).first()
    assert row.asDict() == {
        "prix_moyen_m2": 20.0, "annonces_analysees": 6, "zones_couvertes": 2,
        "prix_median_m2": 12.0, "biens_uniques": 5,
    }


def test_top_values_limit_every_group(spark):
    df = spark.createDataFrame(
        [("a", x) for x in "xxxyyz"] + [("b", "q"), ("b", None)], "source string, zone string"
    )
    got = [(r.source, r.zone, r.rang) for r in profiles.top_values(df, "zone", "source", 2).collect()]
    assert sorted(got) == [("a", "x", 1), ("a", "y", 2), ("b", "q", 1)]


def test_refresh_cleans_the_listings_once(spark, tmp_path, monkeypatch):
    """Loaded listings and stored rejects of a refresh come from the same tagged rows."""
    tables = {
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "TOGOVILLE", 0)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(1, "s", 1, 50.0)]),
        "part": (
            "p_partkey long, p_name string, p_type string, p_size int",
            [(1, "a", "VILLA", 50), (2, "b", "VILLA", 7), (3, "c", "VILLA", 23)],
        ),
        "orders": ("o_orderkey long, o_orderpriority string", [(1, "1-URGENT")]),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
            "l_extendedprice double, l_linestatus string",
            [(1, part, 1, 3, 10.0, 50000.0, "F") for part in (1, 1, 2, 3, 3)],
        ),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    stored, store = [], cleaning.store_tagged
    monkeypatch.setattr(cleaning, "store_tagged", lambda *given: stored.append(1) or store(*given))
    counts = {r.table_name: r.nb_lignes for r in QUERIES["star_refresh"](spark, str(tmp_path)).collect()}
    assert len(stored) == 1
    assert counts["annonce"] == counts["bien_immobilier"] == 1
    assert counts["annonces_rejetees"] == 3
