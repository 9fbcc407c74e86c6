"""Price index with base 100, trend labels, index by property type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loticote.functions import fixed_values as fixed
from loticote.functions.labels import market_position, trend
from loticote.functions.numbers import exact_mean, index_value
from loticote.operators.statistics import global_mean

ZONE_TYPE = ("zone", "type_bien")
ZONE_TYPE_OFFER = ("zone", "type_bien", "type_offre")


def price_index(
    stats: DataFrame,
    keys: Sequence[str] = ZONE_TYPE,
    reference: str | None = fixed.GLOBAL_PERIOD,
) -> DataFrame:
    """Index of each statistic against its reference period.

    The usual key is (zone, type). It leaves the offer out, so a statistic meets the reference
    rows of every offer of its zone and type; pass ``ZONE_TYPE_OFFER`` for one row each.
    ``reference=None`` takes the oldest period in the data.
    """
    if reference is None:
        oldest = stats.agg(F.min("periode").alias("_oldest")).scalar()
        base = stats.where(F.col("periode") == oldest)
    else:
        base = stats.where(F.col("periode") == reference)
    base = base.select(*keys, F.col("prix_moyen_m2").alias("prix_reference"))
    index = index_value(F.col("prix_moyen_m2"), F.col("prix_reference"))
    return (
        stats.join(base, list(keys), "left")
        .withColumn("indice_valeur", index)
        .withColumn("tendance", trend(F.col("indice_valeur")))
    )


def storable_index(index: DataFrame) -> DataFrame:
    """Only rows that have an index value are stored."""
    return index.where(F.col("indice_valeur").isNotNull())


def trend_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("tendance").agg(F.count(F.lit(1)).alias("nb_lignes"))


def trend_examples(index: DataFrame, label: str, n: int = 5) -> DataFrame:
    rows = index.where(F.col("tendance") == label)
    columns = ["zone", "type_bien", "indice_valeur"]
    return rows.select(*columns).orderBy(*columns).limit(n)


def type_index(by_zone: DataFrame) -> DataFrame:
    """Index of each (type, offer) against the mean of all group means."""
    base = global_mean(by_zone, "prix_moyen_m2", scale=6)
    mean = exact_mean(F.col("prix_moyen_m2"), 6)
    return (
        by_zone.groupBy("type_bien", "type_offre")
        .agg(mean.alias("prix_moyen_m2"), F.sum("nb_annonces").alias("nb_annonces"))
        .withColumn("indice", index_value(F.col("prix_moyen_m2"), base, 2))
        .withColumn("tendance", market_position(F.col("indice")))
        .orderBy(F.desc("indice"), "type_bien", "type_offre")
    )
