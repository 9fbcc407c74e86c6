"""Cleaning of raw listings and official values, column by column and as a whole."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from loticote.functions import fixed_values as fixed
from loticote.functions.numbers import clean_price, fill_rooms, to_number
from loticote.functions.text import normalize_text, standardize_offer, standardize_type
from loticote.operators import quality
from loticote.operators.quality import QualityParams
from loticote.session import compiled_apart, materialize
from loticote.sources.readers import SOURCE_HEADER
from loticote.sources.schemas import LISTING, OFFICIAL


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are there; drop a source header that differs from ``source``."""
    extra = [c for c in df.columns if SOURCE_HEADER.match(c) and c != "source"]
    return df.drop(*extra).withColumnsRenamed(dict(names))


def rename_listings(df: DataFrame) -> DataFrame:
    return rename_present(df, fixed.LISTING_COLUMNS)


def rename_official(df: DataFrame) -> DataFrame:
    return rename_present(df, fixed.OFFICIAL_COLUMNS)


def _with_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """A column the source lacks is NULL text."""
    missing = [name for name in schema.names if name not in df.columns]
    return df.withColumns({name: F.lit(None).cast("string") for name in missing})


def _is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, NumericType)


def standardize_listings(raw: DataFrame, null_type: str | None = None) -> DataFrame:
    """Canonical listing columns with clean types; a column the source lacks is NULL."""
    df = _with_columns(rename_listings(raw), LISTING)
    return df.select(
        F.col("titre").cast("string").alias("titre"),
        standardize_offer(F.col("type_offre")).alias("type_offre"),
        standardize_type(F.col("type_bien"), null_type).alias("type_bien"),
        normalize_text(F.col("zone")).alias("zone"),
        clean_price(F.col("prix"), numeric=_is_numeric(df, "prix")).alias("prix"),
        fill_rooms(F.col("pieces"), F.col("type_bien")).alias("pieces"),
        to_number(F.col("surface_m2")).alias("surface_m2"),
        F.col("source"),
    )


def tag_listings(raw: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Standardised listings with the reason of rejection, NULL for valid ones."""
    return quality.tag_reasons(standardize_listings(raw), params)


def store_tagged(raw: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """Tagged listings, stored with one folder per reason.

    A filter on the reason would be pushed below the cleaning and repeat the rules for each row,
    once for the valid side and once for the rejects. On the stored table it picks folders.
    """
    return materialize(tag_listings(compiled_apart(raw), params), "tagged", [quality.REASON])


def clean_listings(
    raw: DataFrame, params: QualityParams = QualityParams()
) -> tuple[DataFrame, DataFrame]:
    """(valid and without copies, rejected with reason)."""
    valid, rejected = quality.split(store_tagged(raw, params))
    return quality.drop_duplicates(valid), rejected


def clean_listings_v1(raw: DataFrame) -> DataFrame:
    """First version of the rules: positive numbers, known zone, copies by title, price, zone.

    Types, offers and room counts stay as they were written.
    """
    df = _with_columns(rename_listings(raw), LISTING)
    df = df.select(
        *[F.col(c).cast("string").alias(c) for c in ("titre", "type_offre", "type_bien")],
        normalize_text(F.col("zone")).alias("zone"),
        clean_price(F.col("prix"), numeric=_is_numeric(df, "prix")).alias("prix"),
        F.col("pieces").cast("string").alias("pieces"),
        to_number(F.col("surface_m2")).alias("surface_m2"),
        "source",
    )
    return quality.drop_duplicates_v1(quality.keep_known_zone(quality.keep_positive(df)))


def clean_official(raw: DataFrame, drop_incomplete: bool = True) -> DataFrame:
    """Canonical official values; rows without a zone or a price per square metre are dropped."""
    df = _with_columns(rename_official(raw), OFFICIAL)
    out = df.select(
        F.col("prefecture"),
        F.col("zone_admin"),
        normalize_text(F.col("zone")).alias("zone"),
        clean_price(F.col("prix"), numeric=_is_numeric(df, "prix")).alias("prix"),
        to_number(F.col("surface_m2")).alias("surface_m2"),
        clean_price(
            F.col("prix_m2_officiel"), numeric=_is_numeric(df, "prix_m2_officiel")
        ).alias("prix_m2_officiel"),
        F.lit(fixed.OFFICIAL_SOURCE).alias("source"),
    )
    return out.dropna(subset=["zone", "prix_m2_officiel"]) if drop_incomplete else out
