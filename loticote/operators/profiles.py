"""Exploration: counts, shares, top values, price profiles, histograms, set questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loticote.functions import fixed_values as fixed
from loticote.functions.numbers import exact_mean, mean_of, percent
from loticote.functions.text import normalize_text
from loticote.operators.summary import (
    STATE,
    grouped_summary,
    largest,
    smallest,
    summarize,
    total,
    up_to_quantile,
    value_counts,
)


def source_overview(df: DataFrame, by: str = "source") -> DataFrame:
    """Rows per source and width of the table."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("nb_lignes"), F.lit(len(df.columns)).alias("nb_colonnes")
    )


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def count_by(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def share(df: DataFrame, by: str, name: str = "nb_annonces") -> DataFrame:
    """Rows per value and their share of all rows, in percent with one decimal."""
    counts = count_by(df.where(F.col(by).isNotNull()), [by], name)
    whole = counts.agg(F.sum(name).alias("_whole")).scalar()
    return counts.withColumn("part", percent(F.col(name), whole, 1))


def share_within(df: DataFrame, by: str, within: str, name: str = "nb_annonces") -> DataFrame:
    """Rows per value and their share inside a group. The window runs over counts, not rows."""
    counts = count_by(df.where(F.col(by).isNotNull()), [within, by], name)
    whole = F.sum(name).over(Window.partitionBy(within))
    return counts.withColumn("part", percent(F.col(name), whole, 1))


def top_values(df: DataFrame, col: str, by: str, n: int, name: str = "nb_annonces") -> DataFrame:
    """The n most frequent values of a column in every group; ties in the order of the values.

    The filter on the row number is applied in every task before the shuffle as well.
    """
    counts = count_by(df.where(F.col(col).isNotNull()), [by, col], name)
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc(name), col))
    return counts.withColumn("rang", place).where(F.col("rang") <= n)


def top_zones_all(df: DataFrame, n: int, max_length: int = fixed.ZONE_MAX_LENGTH) -> DataFrame:
    """The n most listed zones over all sources, unknown and over-long ones left out."""
    known = df.select(normalize_text(F.col("zone")).alias("zone")).where(
        (F.col("zone") != fixed.PROFILE_UNKNOWN_ZONE) & (F.length("zone") <= max_length)
    )
    counts = count_by(known, ["zone"], "nb_annonces")
    return counts.orderBy(F.desc("nb_annonces"), "zone").limit(n)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def zones_per_source(df: DataFrame) -> DataFrame:
    zone = normalize_text(F.col("zone"))
    return df.groupBy("source").agg(F.count_distinct(zone).alias("nb_zones"))


def common_values(df: DataFrame, col: str, by: str) -> DataFrame:
    """Values that occur with every value of ``by``: one scan and one grouping, no joins."""
    pairs = df.select(by, normalize_text(F.col(col)).alias(col)).where(F.col(by).isNotNull()).distinct()
    groups = pairs.agg(F.count_distinct(by)).scalar()
    seen = pairs.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_in"))
    return seen.where(F.col("_in") == groups).select(col)


def in_band(
    value: Column, low: float = fixed.PRICE_M2_MIN, high: float = fixed.PRICE_M2_MAX
) -> Column:
    """Strictly between the bounds; NULL counts as outside."""
    return F.coalesce((value > low) & (value < high), F.lit(False))


def price_profile(
    df: DataFrame,
    low: float = fixed.PRICE_M2_MIN,
    high: float = fixed.PRICE_M2_MAX,
    by: str = "source",
) -> DataFrame:
    """Rows in and out of the price band per group; mean, median and range of those inside."""
    inside = in_band(F.col("prix_m2"), low, high)
    counts = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("nb_total"), F.count_if(inside).alias("nb_valides")
    )
    prices = grouped_summary(
        df.where(inside).select(by, "prix_m2", F.col("prix_m2").alias("_price")),
        [by],
        "prix_m2",
        {"prix_m2_median": 0.5},
        {"prix_m2_min": smallest("_price"), "prix_m2_max": largest("_price")},
        mean="prix_m2_moyen",
        scale=8,
    )
    return counts.join(prices, by, "left").select(
        by,
        "nb_total",
        "nb_valides",
        (F.col("nb_total") - F.col("nb_valides")).alias("nb_rejetes"),
        percent(F.col("nb_valides"), F.col("nb_total"), 1).alias("part_valides"),
        "prix_m2_moyen",
        "prix_m2_median",
        "prix_m2_min",
        "prix_m2_max",
    )


def _edges(low: Column, high: Column, bins: int) -> tuple[Column, Column]:
    """First edge and bin width; a single value gets a range of one around it."""
    flat = low == high
    first = F.when(flat, low - 0.5).otherwise(low)
    last = F.when(flat, high + 0.5).otherwise(high)
    return first, (last - first) / bins


def _bin(value: Column, first: Column, width: Column, bins: int) -> Column:
    """Bin with edge[i] <= value < edge[i+1]; the last one includes its upper edge."""
    guess = F.least(F.floor((value - first) / width), F.lit(bins - 1))
    down = F.when(value < first + guess * width, 1).otherwise(0)
    up = F.when((value >= first + (guess + 1) * width) & (guess < bins - 1), 1).otherwise(0)
    return (guess - down + up).cast("int")


def histogram(df: DataFrame, value: str, bins: int, by: str, trim: float | None = None) -> DataFrame:
    """Equal-width bins over the whole column, counted per value of ``by``.

    With ``trim`` only the rows count whose value does not exceed this quantile. Limit, range and bins all
    come from the counts of the values, so the rows are read once.
    """
    counts = value_counts(df, [by], value)
    if trim is not None:
        counts = up_to_quantile(counts, value, trim)
    first, width = _edges(F.col("_low"), F.col("_high"), bins)
    range_ = counts.agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    edges = range_.select(F.struct(first.alias("first"), width.alias("width")).alias("_edges"))
    first, width = F.col("_edges.first"), F.col("_edges.width")
    placed = counts.withColumn("_edges", edges.scalar()).select(
        by, "_edges", f"{STATE}._rows", _bin(F.col(value), first, width, bins).alias("classe")
    )
    found = placed.groupBy(by, "classe", "_edges").agg(F.sum("_rows").alias("nb_annonces"))
    return found.withColumn("borne_inf", first + F.col("classe") * width).drop("_edges")


def histogram_by_group(df: DataFrame, value: str, bins: int, by: str) -> DataFrame:
    """Equal-width bins over each group's own range, with the group's mean and median.

    The ranges come from the counts of the values, to which they are then joined: one row per group.
    """
    measures = {"_low": smallest(value), "_high": largest(value), "_sum": total(value)}
    counts = value_counts(df.where(F.col(by).isNotNull()), [by], value, measures)
    ranges = summarize(counts, [by], value, {"mediane": 0.5}, measures)
    first, width = _edges(F.col("_low"), F.col("_high"), bins)
    edges = ranges.select(
        by,
        mean_of(F.col("_sum"), F.col("_total")).alias("moyenne"),
        "mediane",
        first.alias("_first"),
        width.alias("_width"),
    )
    lines = [by, "moyenne", "mediane", "_first", "_width"]
    class_ = _bin(F.col(value), F.col("_first"), F.col("_width"), bins)
    placed = counts.join(edges, by).select(*lines, class_.alias("classe"), f"{STATE}._rows")
    found = placed.groupBy(*lines, "classe").agg(F.sum("_rows").alias("nb_annonces"))
    borne = F.col("_first") + F.col("classe") * F.col("_width")
    return found.withColumn("borne_inf", borne).drop("_first", "_width")


def official_top(official: DataFrame, n: int, zone: str = "zone") -> DataFrame:
    """The n zones with the highest mean official price."""
    means = (
        official.where(F.col(zone).isNotNull())
        .groupBy(zone)
        .agg(exact_mean(F.col("prix_m2_officiel")).alias("prix_m2_moyen"))
    )
    return means.orderBy(F.desc_nulls_last("prix_m2_moyen"), zone).limit(n)


def official_summary(official: DataFrame) -> DataFrame:
    return grouped_summary(
        official.select("prix_m2_officiel"),
        [],
        "prix_m2_officiel",
        {"prix_median": 0.5},
        mean="prix_moyen",
    )
