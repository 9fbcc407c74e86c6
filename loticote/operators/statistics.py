"""Price statistics per zone, property type and offer; gap to the official values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loticote.functions import fixed_values as fixed
from loticote.functions.numbers import exact_mean, exact_sum, gap_percent, mean_of, round_scaled
from loticote.functions.text import fold_text
from loticote.operators.summary import grouped_summary, largest, smallest

GROUP = ("zone", "type_bien", "type_offre")


def zone_stats(view: DataFrame, by: Sequence[str] = GROUP, period: str | None = None) -> DataFrame:
    """Mean, median, price range and count of priced listings per group.

    ``period`` names a column to group by as well; without it the period is the fixed label that
    stands for the whole history.
    """
    rows = view.where(F.col("prix_m2") > 0)
    if period is None:
        label: Column = F.lit(fixed.GLOBAL_PERIOD)
        groups = list(by)
    else:
        label = F.col("periode")
        rows = rows.withColumn("periode", F.col(period))
        groups = [*by, "periode"]
    stats = grouped_summary(
        rows.select(*groups, "prix", "prix_m2"),
        groups,
        "prix_m2",
        {"prix_median_m2": 0.5},
        {"prix_min": smallest("prix"), "prix_max": largest("prix")},
        count="nombre_annonces",
        mean="prix_moyen_m2",
    )
    return stats.select(
        *by,
        round_scaled(F.col("prix_moyen_m2"), 2).alias("prix_moyen_m2"),
        round_scaled(F.col("prix_median_m2"), 2).alias("prix_median_m2"),
        "prix_min",
        "prix_max",
        "nombre_annonces",
        label.alias("periode"),
    )


def official_gap(stats: DataFrame, official: DataFrame, aggregate: bool = False) -> DataFrame:
    """Gap of each statistic to the official price of its zone.

    A zone with several official rows yields one result row for each of them. ``aggregate`` takes
    the mean official price of the zone instead, and keeps one row per statistic.
    """
    base = official.select("zone", "prix_m2_officiel")
    if aggregate:
        base = base.groupBy("zone").agg(exact_mean(F.col("prix_m2_officiel")).alias("prix_m2_officiel"))
    gap = gap_percent(F.col("prix_moyen_m2"), F.col("prix_m2_officiel"))
    return stats.join(base, "zone", "left").withColumn("ecart_valeur_venale", gap)


def extreme_zones(stats: DataFrame, n: int, highest: bool) -> DataFrame:
    """The n most or least expensive (zone, type) rows; ties in the order of the columns."""
    mean = F.col("prix_moyen_m2")
    order = mean.desc() if highest else mean.asc()
    tie = ["zone", "type_bien", "type_offre"]
    return (
        stats.orderBy(order, *tie)
        .limit(n)
        .select("zone", "type_bien", "type_offre", "prix_moyen_m2", "nombre_annonces")
    )


def index_by_type_zone(view: DataFrame, min_rows: int = 2) -> DataFrame:
    """Mean price (six decimals) of every (type, offer, zone) with enough listings.

    Spellings that differ only in case or accents are one group. Listings are first summed per
    spelling, so the folding works on groups and not on listings.
    """
    keys = ["type_bien", "type_offre", "zone"]
    spelled = (
        view.where(F.col("prix_m2") > 0)
        .groupBy(*keys)
        .agg(exact_sum(F.col("prix_m2")).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    )
    folded = spelled.groupBy(*[fold_text(F.col(k)).alias(f"_{k}") for k in keys]).agg(
        *[F.min(k).alias(k) for k in keys],
        F.sum("_sum").alias("_sum"),
        F.sum("_rows").alias("nb_annonces"),
    )
    mean = (F.col("_sum") / F.col("nb_annonces")).cast("decimal(22,6)").cast("double")
    return (
        folded.where(F.col("nb_annonces") >= min_rows)
        .select(
            "type_bien",
            "type_offre",
            F.col("zone").alias("zone_nom"),
            mean.alias("prix_moyen_m2"),
            "nb_annonces",
        )
        .orderBy(F.desc("prix_moyen_m2"), "type_bien", "type_offre", "zone_nom")
    )


def zone_mean(stats: DataFrame, zone: str = "zone") -> DataFrame:
    """Mean of the group means by zone."""
    return stats.groupBy(zone).agg(exact_mean(F.col("prix_moyen_m2")).alias("prix_moyen_m2"))


def global_mean(df: DataFrame, value: str, scale: int = 2) -> Column:
    """Mean of a whole column as a scalar subquery."""
    total, count = exact_sum(F.col(value), scale), F.count(value)
    return df.agg(mean_of(total, count).alias("_mean")).scalar()
