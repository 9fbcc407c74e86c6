"""What the batch stores and reads back: statistics, index, exports, ordered outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import views as v
from checks.cleaning_queries import CLEAN, CLEAN_VALUES, title
from checks.price_queries import GAP, OFFICIAL_MEAN, PERIODS, ZONE_MEAN, stored_stats
from checks.registry import query
from checks.star_queries import AT_LOAD, NOT_A_ZONE
from checks.views import LISTINGS, PARAMS, RAW_VALUES, STATS, with_
from loticote.operators import cleaning, dashboard, index, quality, star, statistics
from loticote.plans import batch
from loticote.session import compiled_apart, materialize, scratch_path
from loticote.sources import readers, writers

# All sources are known here, and room counts are those of the cleaning.
STORED = f"""{CLEAN.rstrip()}, {RAW_VALUES}, {CLEAN_VALUES},
listed AS (SELECT titre, type_offre, type_bien, zone, prix, surface_m2,
    CAST(pieces AS VARCHAR) AS pieces, source FROM valid),
zones AS (SELECT DISTINCT zone AS nom FROM listed WHERE zone NOT IN ({NOT_A_ZONE})),
sources AS (SELECT DISTINCT source AS nom FROM listed),
{AT_LOAD},
listings AS (SELECT *, prix_m2 AS p FROM loaded),
{STATS},
official AS (SELECT zone, prix_m2_officiel FROM clean_values),
{OFFICIAL_MEAN},
gaps AS (SELECT stats.*, {GAP} AS ecart_valeur_venale FROM stats LEFT JOIN official_mean USING (zone))
"""
STORED_COLUMNS = (
    "zone", "type_bien", "type_offre", "periode", "prix_moyen_m2", "prix_median_m2", "prix_min",
    "prix_max", "nombre_annonces", "ecart_valeur_venale",
)


def modelled(spark: SparkSession, sf: str) -> str:
    """Clean tables as the batch writes them, then its star, its statistics and its index."""
    out = scratch_path(spark, "batch")
    tagged = cleaning.tag_listings(compiled_apart(v.raw_listings(spark, sf)), PARAMS)
    writers.write_rejects(tagged, f"{out}/etiquetees")
    valid = quality.split(spark.read.parquet(f"{out}/etiquetees"))[0]
    writers.write_parquet(quality.drop_duplicates(valid), f"{out}/annonces_parquet", ["source"])
    writers.write_parquet(cleaning.clean_official(v.raw_official(spark, sf)), f"{out}/venales_parquet")
    batch.model(spark, out)
    batch.measure(spark, out)
    return out


@query("stored_statistics", STORED + f"SELECT {', '.join(STORED_COLUMNS)} FROM gaps")
def stored_statistics(spark: SparkSession, sf: str) -> DataFrame:
    stats = batch.read_statistics(spark, modelled(spark, sf)).select(*STORED_COLUMNS)
    return stats.withColumn("nombre_annonces", F.col("nombre_annonces").cast("long"))


@query(
    "stored_index",
    PERIODS
    + """SELECT zone, type_bien, type_offre, periode, prix_moyen_m2, indice_valeur, tendance
    FROM indexed WHERE indice_valeur IS NOT NULL""",
)
def stored_index(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of every year are stored, read back, indexed and stored again."""
    columns = ["zone", "type_bien", "type_offre", "prix", "prix_m2", "annee"]
    view = v.listings(spark, sf, *columns).withColumn("id_zone", star.dim_key(F.col("zone")))
    yearly = statistics.zone_stats(view, batch.INDEX_KEYS, period="annee")
    root = scratch_path(spark, "results")
    writers.write_results(spark, {"statistiques_zone": yearly}, root)
    stored = writers.read_star_table(spark, root, "statistiques_zone")
    prices = index.storable_index(index.price_index(stored, batch.INDEX_KEYS, reference=None))
    for _ in range(2):  # the second run replaces the first
        writers.write_results(spark, {"indice_immobilier": prices}, root)
    read = writers.read_star_table(spark, root, "indice_immobilier")
    names = view.select("id_zone", "zone").distinct()
    real = {c: F.col(c).cast("double") for c in ("prix_moyen_m2", "indice_valeur")}
    return read.withColumns(real).join(names, "id_zone").drop("id_zone")


@query(
    "filtered_export",
    STORED + """SELECT zone, type_bien, prix_moyen_m2, CAST(nombre_annonces AS BIGINT) AS nombre_annonces
    FROM gaps WHERE type_offre = 'VENTE' AND type_bien IN ('Villa', 'Terrain')""",
)
def filtered_export(spark: SparkSession, sf: str) -> DataFrame:
    out = modelled(spark, sf)
    to = scratch_path(spark, "export")
    batch.export_filtered(spark, out, to, types=["Villa", "Terrain"], offer="VENTE")
    read = readers.read_csv_text(spark, f"{to}/statistiques", multiline=False)
    return read.select(
        "zone",
        "type_bien",
        F.col("prix_moyen_m2").cast("double").alias("prix_moyen_m2"),
        F.col("nombre_annonces").cast("long").alias("nombre_annonces"),
    )


@query(
    "filtered_export_listings",
    STORED + f"""SELECT titre, zone, type_bien, CAST(prix AS DOUBLE) AS prix, prix_m2, {title("source")} AS source
    FROM listings WHERE prix_m2 > 0 AND zone = 'nation_12' AND type_offre = 'VENTE'""",
)
def filtered_export_listings(spark: SparkSession, sf: str) -> DataFrame:
    """The listings of one zone and offer, exported as CSV and read back."""
    out = modelled(spark, sf)
    to = scratch_path(spark, "export")
    batch.export_filtered(spark, out, to, zone="nation_12", offer="VENTE")
    read = readers.read_csv_text(spark, f"{to}/annonces")
    numbers = {c: F.col(c).cast("double") for c in ("prix", "prix_m2")}
    return read.withColumns(numbers).select("titre", "zone", "type_bien", "prix", "prix_m2", "source")


@query(
    "bucketed_zone_view",
    STORED + """SELECT titre, zone, type_bien, type_offre, prix_m2 FROM listings WHERE prix_m2 > 0""",
)
def bucketed_zone_view(spark: SparkSession, sf: str) -> DataFrame:
    """Listings joined to their zones from tables stored in the same buckets."""
    out = modelled(spark, sf)
    batch.store_buckets(spark, out, buckets=16, slices=4)
    view = batch.bucketed_zone_view(spark, out)
    return view.select("titre", "zone", "type_bien", "type_offre", F.col("prix_m2").cast("double").alias("prix_m2"))


# Prices far beyond what the columns hold, for the listings of two zones.
HUGE_MEAN = "CASE WHEN zone IN ('nation_12', 'nation_19') THEN prix_moyen_m2 * 1e7 ELSE prix_moyen_m2 END"


@query(
    "refused_results",
    with_(LISTINGS, STATS)
    + """SELECT 'statistiques_zone' AS table_name, count(*) FILTER (zone NOT IN ('nation_12', 'nation_19'))
    AS nb_lignes FROM stats
    UNION ALL SELECT 'resultats_refuses', count(*) FILTER (zone IN ('nation_12', 'nation_19')) FROM stats""",
)
def refused_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results that no column can hold are stored apart and counted; no value is lost silently."""
    stats = stored_stats(spark, sf).withColumn("id_zone", star.dim_key(F.col("zone")))
    root = scratch_path(spark, "results")
    huge = stats.withColumn("prix_moyen_m2", F.expr(HUGE_MEAN))
    return writers.count_table(spark, writers.write_results(spark, {"statistiques_zone": huge}, root))


def ranked(df: DataFrame, name: str, key: str, n: int, *order: str | Column) -> DataFrame:
    """The first rows of an ordered output with their place in it."""
    place = F.row_number().over(Window.orderBy(*order)).cast("long")
    return df.limit(n).select(F.lit(name).alias("cadre"), place.alias("rang"), F.col(key).alias("cle"))


@query(
    "ordered_outputs",
    with_(LISTINGS, STATS, ZONE_MEAN, "top AS (SELECT * FROM zone_means ORDER BY prix_moyen_m2 DESC, zone LIMIT 20)",
        "per_source AS (SELECT source, count(*) AS n FROM listings GROUP BY source)")
    + """SELECT 'top_zones' AS cadre, row_number() OVER (ORDER BY prix_moyen_m2, zone) AS rang, zone AS cle FROM top
    UNION ALL SELECT 'sources', row_number() OVER (ORDER BY n DESC, source), source FROM per_source""",
)
def ordered_outputs(spark: SparkSession, sf: str) -> DataFrame:
    top = dashboard.top_zones(stored_stats(spark, sf))
    zones = ranked(top, "top_zones", "zone", 20, "prix_moyen_m2", "zone")
    rows = v.listings(spark, sf, "source").withColumn("id_source", star.dim_key(F.col("source")))
    rows = rows.withColumn("id", F.lit("x"))
    names = rows.select(F.col("id_source").alias("id"), F.col("source").alias("nom")).distinct()
    sources = star.listings_per_source(materialize(names, "names"), rows)
    most_first = [F.desc("nombre_annonces"), "source"]
    return zones.unionByName(ranked(sources, "sources", "source", 100, *most_first))
