"""Dimensions, loaded listings, official values and the views over the star schema.

Surrogate keys are hashes that the oracle cannot compute, so results show the names behind them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from checks.cleaning_queries import (
    CLEAN,
    CLEAN_VALUES,
    cleaned,
    parse_rooms,
    real_rooms,
    stored,
    title,
    valid,
    values,
)
from checks.registry import query
from checks.views import RAW_VALUES, exact_round, per_m2, strip
from loticote.functions import fixed_values as fixed
from loticote.operators import cleaning, quality, star
from loticote.session import materialize, scratch_path
from loticote.sources import writers
from loticote.sources.schemas import RESULT_TABLES

# One source is blank, so its listings cannot be loaded.
SOURCE_TEXT = "CASE source WHEN '4-NOT SPECIFIED' THEN NULL ELSE source END"


def listed(spark: SparkSession, sf: str) -> DataFrame:
    """Clean listings, stored like the cleaning batch stores them."""
    return store_listed(valid(spark, sf))


def store_listed(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("source", F.expr(SOURCE_TEXT))
    # The load reads room counts as text; some rows carry one that it refuses.
    rooms = F.when(F.col("type_bien") == "Studio", "1.2.3").otherwise(
        F.col("pieces").cast("string")
    )
    return materialize(rows.withColumn("pieces", rooms), "listings")


LISTED = f"""listed AS (SELECT titre, type_offre, type_bien, zone, prix, surface_m2,
    CASE WHEN type_bien = 'Studio' THEN '1.2.3' ELSE CAST(pieces AS VARCHAR) END AS pieces,
    {SOURCE_TEXT} AS source FROM valid)"""
NOT_A_ZONE = ", ".join(f"'{z}'" for z in fixed.NOT_A_ZONE)
ZONES = f"""zones AS (SELECT DISTINCT zone AS nom, 'Lome' AS commune, 'GOLFE' AS prefecture
    FROM listed WHERE zone NOT IN ({NOT_A_ZONE}))"""
SOURCES = f"""known AS (SELECT * FROM {values(fixed.SOURCE_NAMES)}),
sources AS (SELECT DISTINCT nom FROM (
    SELECT coalesce(known.w, {title(strip("source"))}) AS nom FROM listed
    LEFT JOIN known ON known.k = lower({strip("source")}) WHERE source IS NOT NULL
    UNION ALL SELECT 'ValeursVenales'))"""
# The loaded rows: zone and source known, room count readable.
AT_LOAD = f"""at_load AS (SELECT * FROM {values(fixed.PROPERTY_TYPES_AT_LOAD)}),
loaded AS (SELECT left(titre, 255) AS titre, prix, surface_m2,
    {per_m2("prix", "surface_m2")} AS prix_m2,
    {parse_rooms("pieces")} AS pieces,
    coalesce(at_load.w, {title("type_bien")}, 'Inconnu') AS type_bien, type_offre, zone, source
    FROM listed LEFT JOIN at_load ON at_load.k = lower(type_bien)
    WHERE zone IN (SELECT nom FROM zones) AND lower(source) IN (SELECT lower(nom) FROM sources)
    AND coalesce(pieces, '') <> '1.2.3')"""
BASE = f"{CLEAN.rstrip()},\n{LISTED},\n{ZONES},\n{SOURCES},\n{AT_LOAD}"
UPSERTED = f"""{CLEAN_VALUES},
all_zones AS (SELECT * FROM zones UNION ALL SELECT zone, 'Lome', min(prefecture)
    FROM clean_values WHERE zone NOT IN (SELECT nom FROM zones) GROUP BY zone)"""
STAR = f"{BASE},\n{RAW_VALUES},\n{UPSERTED}\n"
BASE += "\n"


class Star:
    """Stored dimensions and loaded listings of one run."""

    def __init__(self, spark: SparkSession, sf: str) -> None:
        rows, self.rejected = cleaned(spark, sf)
        self.listings = store_listed(rows)
        self.sources = materialize(star.dim_source(self.listings), "sources")
        self.zones = materialize(star.dim_zone(self.listings), "zones")

    def loaded(self) -> DataFrame:
        return star.load_listings(self.listings, self.zones, self.sources)


def with_names(df: DataFrame, base: Star) -> DataFrame:
    zones = base.zones.select(F.col("id").alias("id_zone"), F.col("nom").alias("zone"))
    return df.join(zones, "id_zone").drop("id_zone")


@query("dim_source", BASE + "SELECT nom, '' AS url, '2024-01-01' AS date_collecte FROM sources")
def dim_source(spark: SparkSession, sf: str) -> DataFrame:
    df = star.dim_source(listed(spark, sf))
    return df.select("nom", "url", F.col("date_collecte").cast("string").alias("date_collecte"))


@query("dim_zone", BASE + "SELECT * FROM zones")
def dim_zone(spark: SparkSession, sf: str) -> DataFrame:
    return star.dim_zone(listed(spark, sf)).select("nom", "commune", "prefecture")


@query("zone_upsert", STAR + "SELECT * FROM all_zones")
def zone_upsert(spark: SparkSession, sf: str) -> DataFrame:
    zones = materialize(star.dim_zone(listed(spark, sf)), "zones")
    official = cleaning.clean_official(v.raw_official(spark, sf))
    return star.upsert_zones(zones, official).select("nom", "commune", "prefecture")


@query(
    "dim_property",
    BASE
    + """SELECT type_bien, type_offre, surface_m2, CAST(pieces AS DOUBLE) AS pieces, zone
    FROM loaded""",
)
def dim_property(spark: SparkSession, sf: str) -> DataFrame:
    base = Star(spark, sf)
    stored = writers.conform(star.dim_property(base.loaded()), "bien_immobilier")
    named = with_names(stored, base).select("type_bien", "type_offre", "surface_m2", "pieces", "zone")
    return real_rooms(named).withColumn("surface_m2", F.col("surface_m2").cast("double"))


@query("load_fact", BASE + "SELECT titre, prix, prix_m2, type_bien, zone FROM loaded")
def load_fact(spark: SparkSession, sf: str) -> DataFrame:
    base = Star(spark, sf)
    return loaded_rows(base.loaded(), base)


def loaded_rows(loaded: DataFrame, base: Star) -> DataFrame:
    """What the fact table holds of each listing, in the widths of its columns."""
    return with_names(loaded, base).select(
        "titre",
        F.col("prix").cast("decimal(15,2)").cast("double").alias("prix"),
        F.col("prix_m2").cast("decimal(10,2)").cast("double").alias("prix_m2"),
        "type_bien",
        "zone",
    )


@query("pair_listings", BASE + "SELECT titre, prix, prix_m2, type_bien, zone FROM loaded")
def pair_listings(spark: SparkSession, sf: str) -> DataFrame:
    base = Star(spark, sf)
    loaded = materialize(base.loaded(), "loaded")
    listing = writers.conform(star.fact_listing(loaded), "annonce")
    return loaded_rows(star.pair_listings(listing, star.dim_property(loaded)), base)


@query(
    "load_skipped",
    BASE
    + """SELECT CASE WHEN zone NOT IN (SELECT nom FROM zones) THEN 'zone_inconnue'
    WHEN source IS NULL THEN 'source_inconnue' WHEN pieces = '1.2.3' THEN 'pieces_invalides'
    ELSE 'chargee' END AS raison_ignore, count(*) AS nb_lignes FROM listed GROUP BY ALL""",
)
def load_skipped(spark: SparkSession, sf: str) -> DataFrame:
    base = Star(spark, sf)
    return star.load_skipped(base.listings, base.zones, base.sources)


# Some titles come with a price, some official rows with a price per m2, that no column can hold.
HUGE = "CASE WHEN prix > 100000 THEN 1e14 ELSE prix END"
HUGE_VALUE = "CASE WHEN prix_m2_officiel > 9500 THEN 2e9 ELSE prix_m2_officiel END"


@query(
    "skipped_rows",
    BASE.rstrip()
    + f""", {RAW_VALUES}, {CLEAN_VALUES},
    annonces AS (SELECT CASE WHEN zone NOT IN (SELECT nom FROM zones) THEN 'zone_inconnue'
    WHEN source IS NULL THEN 'source_inconnue' WHEN pieces = '1.2.3' THEN 'pieces_invalides'
    WHEN prix > 100000 THEN 'valeur_hors_bornes' END AS raison_ignore FROM listed),
    valeurs AS (SELECT CASE WHEN zone IS NULL THEN 'zone_inconnue'
    WHEN prix_m2_officiel > 9500 THEN 'valeur_hors_bornes' END AS raison_ignore FROM clean_values)
    SELECT 'annonces' AS origine, raison_ignore, count(*) AS nb_lignes FROM annonces GROUP BY ALL
    UNION ALL SELECT 'valeurs', raison_ignore, count(*) FROM valeurs GROUP BY ALL""",
)
def skipped_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded rows (no reason) and skipped ones by reason: together all rows that were given."""
    base = Star(spark, sf)
    listings = base.listings.withColumn("prix", F.expr(HUGE))
    tagged = star.tag_load(listings, base.zones, base.sources)
    official = cleaning.clean_official(v.raw_official(spark, sf))
    stored, refused = star.split_official(official.withColumn("prix_m2_officiel", F.expr(HUGE_VALUE)))
    parts = {
        "annonces": star.split_load(tagged),
        "valeurs": (stored, refused),
    }
    counts = []
    for name, (loaded, skipped) in parts.items():
        rows = loaded.select(F.lit(None).cast("string").alias(star.SKIP_REASON)).unionByName(
            skipped.select(star.SKIP_REASON)
        )
        counted = rows.groupBy(star.SKIP_REASON).agg(F.count(F.lit(1)).alias("nb_lignes"))
        counts.append(counted.withColumn("origine", F.lit(name)))
    return counts[0].unionByName(counts[1])


@query(
    "unmatched_keys",
    STAR
    + """SELECT * FROM (SELECT DISTINCT 'zone' AS champ, zone AS valeur FROM clean_values
    WHERE zone NOT IN (SELECT nom FROM zones) ORDER BY valeur LIMIT 5)
    UNION ALL SELECT DISTINCT 'source', lower(c_mktsegment) FROM customer""",
)
def unmatched_keys(spark: SparkSession, sf: str) -> DataFrame:
    base = Star(spark, sf)
    official = cleaning.clean_official(v.raw_official(spark, sf))
    zones = quality.unmatched(official, base.zones, "zone", limit=5)
    segments = v.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("source"))
    sources = quality.unmatched(segments, base.sources, "source")
    return zones.select(F.lit("zone").alias("champ"), F.col("zone").alias("valeur")).unionByName(
        sources.select(F.lit("source").alias("champ"), F.col("source").alias("valeur"))
    )


def stored_official(spark: SparkSession, sf: str, base: Star) -> tuple[DataFrame, DataFrame]:
    official = cleaning.clean_official(v.raw_official(spark, sf))
    zones = materialize(star.upsert_zones(base.zones, official), "all-zones")
    return star.fact_official(official, zones, base.zones), zones


OFFICIAL_ROWS = """SELECT zone, prix_m2_officiel, surface_m2, prix AS valeur_totale
    FROM clean_values"""


@query("fact_official", STAR + OFFICIAL_ROWS)
def fact_official(spark: SparkSession, sf: str) -> DataFrame:
    fact, zones = stored_official(spark, sf, Star(spark, sf))
    names = zones.select(F.col("id").alias("id_zone"), F.col("nom").alias("zone"))
    return fact.join(names, "id_zone").drop("id_zone")


@query("official_view", STAR + OFFICIAL_ROWS + " WHERE prix_m2_officiel IS NOT NULL")
def official_view(spark: SparkSession, sf: str) -> DataFrame:
    fact, zones = stored_official(spark, sf, Star(spark, sf))
    return star.official_view(fact, zones)


@query(
    "listing_view",
    BASE
    + f"""SELECT prix, prix_m2, loaded.titre, type_bien, type_offre, surface_m2, zone,
    {title("source")} AS source FROM loaded WHERE prix_m2 > 0""",
)
def listing_view(spark: SparkSession, sf: str) -> DataFrame:
    base = Star(spark, sf)
    return star.listing_view(base.loaded(), base.zones, base.sources)


@query(
    "stats_view",
    BASE
    + """SELECT zone AS zone_nom, type_bien, count(*) AS nombre_annonces, min(prix) AS prix_min,
    max(prix) AS prix_max FROM loaded WHERE prix_m2 > 0 GROUP BY ALL""",
)
def stats_view(spark: SparkSession, sf: str) -> DataFrame:
    base = Star(spark, sf)
    priced = base.loaded().where(F.col("prix_m2") > 0)
    stats = priced.groupBy("id_zone", "type_bien").agg(
        F.count(F.lit(1)).alias("nombre_annonces"),
        F.min("prix").alias("prix_min"),
        F.max("prix").alias("prix_max"),
    )
    return star.stats_view(stats, base.zones).drop("id_zone")


@query(
    "listings_per_source",
    BASE
    + f"""SELECT nom AS source, count(loaded.prix) AS nombre_annonces FROM sources
    LEFT JOIN loaded ON {title("loaded.source")} = nom GROUP BY nom""",
)
def listings_per_source(spark: SparkSession, sf: str) -> DataFrame:
    base = Star(spark, sf)
    return star.listings_per_source(base.sources, base.loaded())


@query(
    "rejects_table",
    CLEAN
    + """SELECT left(titre, 255) AS titre, left(zone, 255) AS zone, prix, surface_m2,
    left(type_bien, 100) AS type_bien, left(type_offre, 50) AS type_offre,
    left(source, 100) AS source, left(raison_rejet, 100) AS raison_rejet
    FROM tagged WHERE raison_rejet IS NOT NULL""",
)
def rejects_table(spark: SparkSession, sf: str) -> DataFrame:
    return star.rejects_table(quality.split(stored(spark, sf))[1])


@query(
    "star_refresh",
    STAR
    + """SELECT 'source_donnees' AS table_name, count(*) AS nb_lignes FROM sources
    UNION ALL SELECT 'zone_geographique', count(*) FROM all_zones
    UNION ALL SELECT 'annonce', count(*) FROM loaded
    UNION ALL SELECT 'bien_immobilier', count(*) FROM loaded
    UNION ALL SELECT 'valeur_venale', count(*) FROM clean_values
    UNION ALL SELECT 'annonces_rejetees', count(*) FROM tagged WHERE raison_rejet IS NOT NULL
    UNION ALL SELECT 'statistiques_zone', 0 UNION ALL SELECT 'indice_immobilier', 0""",
)
def star_refresh(spark: SparkSession, sf: str) -> DataFrame:
    base = Star(spark, sf)
    official, zones = stored_official(spark, sf, base)
    loaded = materialize(base.loaded(), "loaded")
    tables = {
        "source_donnees": base.sources,
        "zone_geographique": zones,
        "annonce": star.fact_listing(loaded),
        "bien_immobilier": star.dim_property(loaded),
        "valeur_venale": official,
        "annonces_rejetees": star.rejects_table(base.rejected),
    }
    root = scratch_path(spark, "star")
    # A second refresh replaces the first one and does not add to it.
    writers.refresh_star(spark, {"zone_geographique": base.zones}, root)
    stale = base.zones.select(F.col("id").alias("id_zone"), F.lit("2023").alias("periode"))
    writers.write_results(spark, {name: writers.conform(stale, name) for name in RESULT_TABLES}, root)
    return writers.refresh_star(spark, tables, root)
