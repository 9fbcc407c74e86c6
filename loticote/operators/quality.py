"""Data quality: named rejection reasons, valid/reject split, de-duplication, reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loticote.functions import fixed_values as fixed
from loticote.functions.numbers import percent, ratio_per_m2
from loticote.functions.text import contains_any, normalize_text

REASON = "raison_rejet"
IDENTITY = ("titre", "prix", "zone", "surface_m2")
IDENTITY_V1 = ("titre", "prix", "zone")


@dataclass(frozen=True)
class QualityParams:
    """Bounds and word lists of the rules."""

    price_m2_min: float = fixed.PRICE_M2_MIN
    price_m2_max: float = fixed.PRICE_M2_MAX
    zone_max_length: int = fixed.ZONE_MAX_LENGTH
    suspicious_words: tuple[str, ...] = fixed.SUSPICIOUS_WORDS
    invalid_zones: tuple[str, ...] = fixed.INVALID_ZONES
    # A listing without a zone cannot be loaded, so it is refused here with a reason.
    reject_null_zone: bool = True


def reject_reason(
    zone: Column, price: Column, surface: Column, params: QualityParams = QualityParams()
) -> Column:
    """First rule that the row breaks, or NULL. One CASE, so each row stops at its first match."""
    text = F.lower(zone)
    per_m2 = ratio_per_m2(price, surface)
    invalid = text.isin(*params.invalid_zones)
    if params.reject_null_zone:
        invalid = zone.isNull() | invalid
    too_long, no_zone, describes, missing, too_high, too_low = fixed.REASONS
    return (
        F.when(F.length(zone) > params.zone_max_length, too_long)
        .when(invalid, no_zone)
        .when(contains_any(text, params.suspicious_words), describes)
        .when(price.isNull() | surface.isNull(), missing)
        .when(per_m2 > params.price_m2_max, too_high)
        .when(per_m2 < params.price_m2_min, too_low)
    )


def tag_reasons(df: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    reason = reject_reason(F.col("zone"), F.col("prix"), F.col("surface_m2"), params)
    return df.withColumn(REASON, reason)


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason, rejected rows with it)."""
    valid = tagged.where(F.col(REASON).isNull()).drop(REASON)
    return valid, tagged.where(F.col(REASON).isNotNull())


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key, always the same one: the first in the order of the other columns.

    The filter on the row number lets Spark keep one row per key in every task before the
    shuffle, so a key with very many copies does not pile up in one task. Rows are sorted for it twice. A
    hash of the key comes first in that order: a number decides nearly every comparison, where a first
    column with few values, such as the source, would leave them to the text columns.
    """
    rest = order_by or [c for c in df.columns if c not in keys] or keys
    order = [F.col(c).asc_nulls_first() for c in rest]
    place = F.row_number().over(Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def drop_duplicates(valid: DataFrame) -> DataFrame:
    """Copies of a listing within one source; the same listing in two sources stays twice."""
    return dedup(valid, ["source", *IDENTITY])


def drop_duplicates_v1(df: DataFrame) -> DataFrame:
    return dedup(df, ["source", *IDENTITY_V1])


def keep_positive(df: DataFrame) -> DataFrame:
    return df.where((F.col("prix") > 0) & (F.col("surface_m2") > 0))


def keep_known_zone(df: DataFrame) -> DataFrame:
    """Drops the unknown-zone spellings and, as ``NOT IN`` does, rows without a zone."""
    return df.where(~F.lower(F.col("zone")).isin(*fixed.UNKNOWN_ZONES_V1))


def reject_report(tagged: DataFrame) -> DataFrame:
    """Rejected rows by source and reason, most frequent first within a source."""
    return (
        tagged.where(F.col(REASON).isNotNull())
        .groupBy("source", REASON)
        .agg(F.count(F.lit(1)).alias("nb_lignes"))
        .orderBy("source", F.desc("nb_lignes"), REASON)
    )


def quality_summary(tagged: DataFrame) -> DataFrame:
    """Per source and in total: rows before, valid, rejected and the rejection rate.

    "Before" is valid rows after de-duplication plus rejected rows, so copies are not counted.
    Distinct valid listings and rejects are counted in the same pass: the identity columns are
    blanked for rejects, which then collapse into one group per source.
    """
    rejected = F.col(REASON).isNotNull()
    identity = [F.when(~rejected, F.col(c)).alias(c) for c in IDENTITY]
    groups = (
        tagged.select("source", rejected.alias("_rejected"), *identity)
        .groupBy("source", "_rejected", *IDENTITY)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    return _summary_of_counts(
        groups.groupBy("source").agg(
            F.count_if(~F.col("_rejected")).alias("_valid"),
            F.sum(F.when(F.col("_rejected"), F.col("_rows")).otherwise(0)).alias("_reject"),
        )
    )


def stored_summary(valid: DataFrame, rejected: DataFrame) -> DataFrame:
    """The same report from stored valid rows without copies and stored rejects: counts only."""
    none = F.lit(0).cast("long")
    kept = valid.groupBy("source").agg(F.count(F.lit(1)).alias("_valid")).withColumn("_reject", none)
    refused = rejected.groupBy("source").agg(F.count(F.lit(1)).alias("_reject"))
    counts = kept.unionByName(refused.withColumn("_valid", none)).groupBy("source")
    return _summary_of_counts(counts.agg(F.sum("_valid").alias("_valid"), F.sum("_reject").alias("_reject")))


def _summary_of_counts(per_source: DataFrame) -> DataFrame:
    label = F.when(F.grouping("source") == 1, "TOTAL").otherwise(F.col("source"))
    before = F.sum("_valid") + F.sum("_reject")
    return per_source.rollup("source").agg(
        label.alias("perimetre"),
        before.alias("avant"),
        F.sum("_valid").alias("valides"),
        F.sum("_reject").alias("rejetes"),
        F.coalesce(percent(F.sum("_reject"), before, 2), F.lit(0.0)).alias("taux_rejet"),
    ).drop("source")


def missing_profile(df: DataFrame, by: str) -> DataFrame:
    """Missing values per group and column, columns without any left out. One pass."""
    columns = [c for c in df.columns if c != by]
    counts = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    long = counts.unpivot([by, "_rows"], columns, "colonne", "manquants")
    share = percent(F.col("manquants"), F.col("_rows"), 1).alias("pourcentage")
    return long.where(F.col("manquants") > 0).select(by, "colonne", "manquants", share)


def suspicious_zones(
    df: DataFrame, words: Sequence[str] = fixed.PROFILE_WORDS, by: str = "source"
) -> DataFrame:
    """Distinct zones, as written, that hold one of the words in any case."""
    return df.where(contains_any(F.lower(F.col("zone")), words)).select(by, "zone").distinct()


def long_zones(
    df: DataFrame, max_length: int = fixed.ZONE_MAX_LENGTH, by: str = "source"
) -> DataFrame:
    return df.where(F.length("zone") > max_length).select(by, "zone").distinct()


def unmatched(
    df: DataFrame, dim: DataFrame, key: str, name: str = "nom", limit: int | None = None
) -> DataFrame:
    """Distinct values of a column that the dimension does not know, in order."""
    values = df.select(normalize_text(F.col(key)).alias(key)).where(F.col(key).isNotNull())
    known = dim.select(normalize_text(F.col(name)).alias(key))
    missing = values.distinct().join(known, key, "left_anti").orderBy(key)
    return missing if limit is None else missing.limit(limit)
