"""Shares, top values, distinct values and the profile of the official values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from checks.registry import query
from checks.views import LISTINGS, OFFICIAL, RAW, mean, median, percent, scaled_round, strip, with_
from loticote.operators import profiles


@query(
    "source_share",
    with_(LISTINGS)
    + f""", counts AS (SELECT source, count(*) AS nb_annonces FROM listings GROUP BY source)
    SELECT source, nb_annonces, {percent("nb_annonces", "(SELECT sum(nb_annonces) FROM counts)", 1)}
    AS part FROM counts""",
)
def source_share(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.share(v.listings(spark, sf, "source"), "source")


@query(
    "offer_share",
    with_(LISTINGS)
    + f""", counts AS (SELECT source, type_offre, count(*) AS nb_annonces FROM listings
    GROUP BY ALL), sums AS (SELECT *, sum(nb_annonces) OVER (PARTITION BY source) AS total
    FROM counts)
    SELECT source, type_offre, nb_annonces, {percent("nb_annonces", "total", 1)} AS part
    FROM sums""",
)
def offer_share(spark: SparkSession, sf: str) -> DataFrame:
    df = v.listings(spark, sf, "source", "type_offre")
    return profiles.share_within(df, "type_offre", "source")


def top_sql(column: str, n: int) -> str:
    return f""", raw_values AS (SELECT source, {column} AS valeur, count(*) AS nb_annonces
    FROM raw WHERE {column} IS NOT NULL GROUP BY ALL), placed AS (SELECT *, row_number() OVER (
    PARTITION BY source ORDER BY nb_annonces DESC, valeur) AS place FROM raw_values)
    SELECT source, valeur, nb_annonces, CAST(place AS INTEGER) AS rang FROM placed
    WHERE place <= {n}"""


def raw_column(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return v.raw_listings(spark, sf).select("source", F.col(name).alias("valeur"))


@query("top_zones_by_source", with_(RAW) + top_sql('"Quartier"', 10))
def top_zones_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.top_values(raw_column(spark, sf, "Quartier"), "valeur", "source", 10)


@query("top_types_by_source", with_(RAW) + top_sql('"Type de bien"', 8))
def top_types_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.top_values(raw_column(spark, sf, "Type de bien"), "valeur", "source", 8)


NORMAL_ZONE = f"lower({strip('''\"Quartier\"''')})"


def source_zones(spark: SparkSession, sf: str) -> DataFrame:
    return v.raw_listings(spark, sf).select("source", F.col("Quartier").alias("zone"))


SOURCES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(
    "top_zones_all",
    with_(RAW)
    + f"""SELECT {NORMAL_ZONE} AS zone, count(*) AS nb_annonces FROM raw
    WHERE {NORMAL_ZONE} <> 'non spécifié'
    AND length({NORMAL_ZONE}) <= 30 GROUP BY 1 ORDER BY nb_annonces DESC, zone LIMIT 15""",
)
def top_zones_all(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.top_zones_all(source_zones(spark, sf), 15)


@query(
    "common_zones",
    with_(RAW)
    + " INTERSECT ".join(
        f"SELECT {NORMAL_ZONE} AS zone FROM raw WHERE source = '{s}' AND \"Quartier\" IS NOT NULL"
        for s in SOURCES
    ),
)
def common_zones(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.common_values(source_zones(spark, sf), "zone", "source")


@query(
    "zones_per_source",
    with_(RAW)
    + f"SELECT source, count(DISTINCT {NORMAL_ZONE}) AS nb_zones FROM raw GROUP BY source",
)
def zones_per_source(spark: SparkSession, sf: str) -> DataFrame:
    raw = v.raw_listings(spark, sf).select("source", F.col("Quartier").alias("zone"))
    return profiles.zones_per_source(raw)


@query(
    "distinct_values",
    with_(LISTINGS)
    + """SELECT 'zone' AS champ, zone AS valeur FROM listings GROUP BY ALL
    UNION ALL SELECT 'type_bien', type_bien FROM listings GROUP BY ALL
    UNION ALL SELECT 'source', source FROM listings GROUP BY ALL""",
)
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    lists = [
        profiles.distinct_values(v.listings(spark, sf, c), c).select(
            F.lit(c).alias("champ"), F.col(c).alias("valeur")
        )
        for c in ("zone", "type_bien", "source")
    ]
    return lists[0].unionByName(lists[1]).unionByName(lists[2])


@query(
    "official_top15",
    with_(OFFICIAL)
    + f"""SELECT zone, {mean("prix_m2_officiel")} AS prix_m2_moyen FROM official GROUP BY zone
    ORDER BY prix_m2_moyen DESC NULLS LAST, zone LIMIT 15""",
)
def official_top15(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.official_top(v.official(spark, sf), 15)


@query(
    "official_summary",
    with_(OFFICIAL)
    + f"""SELECT {mean("prix_m2_officiel")} AS prix_moyen,
    {scaled_round(median("prix_m2_officiel"), 4)} AS prix_median FROM official""",
)
def official_summary(spark: SparkSession, sf: str) -> DataFrame:
    df = profiles.official_summary(v.official(spark, sf))
    return df.withColumn("prix_median", F.rint(F.col("prix_median") * 10000) / 10000)
