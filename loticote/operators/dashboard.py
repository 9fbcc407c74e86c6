"""Dashboard tables: filters, key figures, rankings, comparison with official values, map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loticote.functions import fixed_values as fixed
from loticote.functions.labels import green_to_red, thousands
from loticote.functions.numbers import exact_mean
from loticote.functions.text import normalize_text, title_case
from loticote.operators.statistics import zone_mean
from loticote.operators.summary import grouped_summary


def apply_filters(
    df: DataFrame,
    zone: str | None = None,
    types: Sequence[str] = (),
    offer: str | None = None,
    zone_column: str = "zone",
) -> DataFrame:
    """Rows of one zone, some property types and one offer; what is not given is not filtered."""
    if zone is not None:
        df = df.where(F.col(zone_column) == zone)
    if types:
        df = df.where(F.col("type_bien").isin(*types))
    if offer is not None:
        df = df.where(F.col("type_offre") == offer)
    return df


def kpis(stats: DataFrame, listings: DataFrame | None = None, zone: str = "zone") -> DataFrame:
    """Key figures of the page in one row.

    The listings are counted from the statistics, in which each group has its number of listings; a group
    that stands for several official values counts once. ``listings`` counts these rows instead.
    """
    if listings is None:
        keys = [c for c in (zone, "type_bien", "type_offre", "periode") if c in stats.columns]
        groups = stats.groupBy(*keys).agg(F.any_value("nombre_annonces").alias("_rows"))
        unique = groups.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("_rows")).scalar()
    else:
        unique = listings.agg(F.count(F.lit(1)).alias("_rows")).scalar()
    medians = grouped_summary(
        stats.select("prix_median_m2"), [], "prix_median_m2", {"prix_median_m2": 0.5}
    )
    return stats.agg(
        exact_mean(F.col("prix_moyen_m2")).alias("prix_moyen_m2"),
        F.sum("nombre_annonces").alias("annonces_analysees"),
        F.count_distinct(zone).alias("zones_couvertes"),
    ).select(
        "*",
        medians.scalar().alias("prix_median_m2"),
        unique.alias("biens_uniques"),
    )


def top_zones(stats: DataFrame, n: int = 20, zone: str = "zone") -> DataFrame:
    """The n zones with the highest mean, shown from the lowest of them up."""
    means = zone_mean(stats, zone)
    return means.orderBy(F.desc("prix_moyen_m2"), zone).limit(n).orderBy("prix_moyen_m2", zone)


def market_vs_official(listings: DataFrame, official: DataFrame, n: int = 15) -> DataFrame:
    """Mean asking price against mean official price, zones both tables know, dearest first.

    Both sides are averaged per zone before they meet, so the join sees one row per zone. Official
    rows without a price do not count.
    """
    market = listings.groupBy("zone").agg(exact_mean(F.col("prix_m2")).alias("prix_marche_m2"))
    stated = official.where(F.col("prix_m2_officiel").isNotNull()).groupBy("zone").agg(
        exact_mean(F.col("prix_m2_officiel")).alias("prix_venale_m2")
    )
    return market.join(stated, "zone").orderBy(F.desc("prix_marche_m2"), "zone").limit(n)


def coordinates(spark) -> DataFrame:
    return spark.createDataFrame(
        list(fixed.ZONE_COORDINATES), "zone_lower string, lat double, lon double"
    )


def zone_map(stats: DataFrame, coords: DataFrame | None = None, zone: str = "zone") -> DataFrame:
    """Zone means with coordinates. The fixed table (18 rows) is broadcast, a given one is not."""
    known = F.broadcast(coordinates(stats.sparkSession)) if coords is None else coords
    means = zone_mean(stats, zone).withColumn("zone_lower", normalize_text(F.col(zone)))
    return means.join(known, "zone_lower").drop("zone_lower")


def color_scale(df: DataFrame, value: str = "prix_moyen_m2") -> DataFrame:
    """Colour of each row between the lowest (green) and the highest (red) value."""
    bounds = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("_range"))
    low, high = F.col("_range.low"), F.col("_range.high")
    ratio = (F.col(value) - low) / (high - low + 1)
    ranged = df.withColumn("_range", bounds.scalar())
    return ranged.withColumn("couleur", green_to_red(ratio)).drop("_range")


def map_points(stats: DataFrame, coords: DataFrame | None = None, zone: str = "zone") -> DataFrame:
    """Points of the map with colour and caption."""
    points = color_scale(zone_map(stats, coords, zone))
    caption = F.concat(
        title_case(F.col(zone)), F.lit(" - "), thousands(F.col("prix_moyen_m2")), F.lit(" FCFA/m2")
    )
    return points.withColumn("legende", caption)


def extreme_listings(
    listings: DataFrame, n: int, highest: bool, floor: float | None = None
) -> DataFrame:
    """The n listings with the highest or lowest price per square metre."""
    rows = listings if floor is None else listings.where(F.col("prix_m2") > floor)
    price = F.col("prix_m2")
    columns = ["titre", "zone", "type_bien", "prix_m2", "source"]
    order = price.desc() if highest else price.asc()
    return rows.select(*columns).orderBy(order, *columns).limit(n)


def zone_table(stats: DataFrame) -> DataFrame:
    """Comparison table, the columns that are there, dearest first."""
    columns = [c for c in fixed.TABLE_COLUMNS if c in stats.columns]
    ties = [c for c in columns if c != "prix_moyen_m2"]
    return stats.select(*columns).orderBy(F.desc("prix_moyen_m2"), *ties)


def format_prices(df: DataFrame, columns: Sequence[str], unit: str = "") -> DataFrame:
    """Whole numbers with thousands separators, as text."""
    text = {c: F.concat(thousands(F.col(c)), F.lit(unit)) for c in columns}
    return df.withColumns(text)
