"""Exact group summaries with quantiles, for groups of any size.

Spark's exact percentile keeps every distinct value of a group in the memory of one task. Here equal values of
a group are counted together first; partial aggregation shrinks that before the shuffle, and everything else is
taken from these counts, so the input is read once. The counts of *parts* (narrow ranges of values, at most some
hundred thousand for each power of e) tell where the wanted ranks of a group are, and only the values of these
parts are ordered. A group with a third of all rows is spread over its values, then over its parts; the one
window that runs over a whole group sees one row for each of its parts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loticote.functions.numbers import exact_sum, mean_of

# Neighbouring cells differ by about three percent; every cell is cut once more, so that values that crowd
# in one cell do not meet in one task.
CELLS_PER_E_FOLD = 32
PARTS_PER_CELL = 4096

STATE = "_state"


@dataclass(frozen=True)
class Measure:
    """An aggregate computed per value and merged per group."""

    partial: Column
    merge: Callable[[str], Column]


def smallest(col: str) -> Measure:
    return Measure(F.min(col), F.min)


def largest(col: str) -> Measure:
    return Measure(F.max(col), F.max)


def total(col: str, scale: int = 2) -> Measure:
    return Measure(exact_sum(F.col(col), scale), F.sum)


def value_cell(value: Column) -> Column:
    """Cell number, growing with the value; cells widen with its size, so they stay few."""
    cell = (F.signum(value) * F.floor(F.log1p(F.abs(value)) * CELLS_PER_E_FOLD)).cast("int")
    return F.coalesce(cell, F.lit(0))


def value_part(value: Column) -> Column:
    """Part of its cell, growing with the value like the cell number."""
    place = F.signum(value) * F.log1p(F.abs(value)) * CELLS_PER_E_FOLD
    return F.coalesce(F.floor((place - F.col("_cell")) * PARTS_PER_CELL).cast("int"), F.lit(0))


def value_counts(
    df: DataFrame, by: Sequence[str], value: str, measures: Mapping[str, Measure] | None = None
) -> DataFrame:
    """Rows (``_rows``) and measures of every value of every group, in the struct ``_state``.

    Whatever is computed from the result shares its shuffle, scalar subqueries included, as long as it
    belongs to one query. For that every use has to need the same columns: all aggregates are in one struct
    that the optimizer does not take apart, and the last filter, which keeps every row, needs it.
    """
    aggregates = {"_rows": F.count(F.lit(1))} | {k: m.partial for k, m in (measures or {}).items()}
    state = F.element_at(F.array(F.struct(*[c.alias(k) for k, c in aggregates.items()])), 1)
    rows = df.where(F.col(value).isNotNull())
    return rows.groupBy(*by, value).agg(state.alias(STATE)).where(F.col(f"{STATE}._rows") > 0)


def grouped_summary(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    measures: Mapping[str, Measure] | None = None,
    count: str | None = None,
    mean: str | None = None,
    scale: int = 2,
) -> DataFrame:
    """One row per group: exact quantiles (linear interpolation), count, mean, other measures.

    Rows with a NULL value or a NULL group are left out. ``mean`` is the decimal sum at ``scale``
    digits over the count. With no ``by`` the whole table is one group.
    """
    measures = dict(measures or {})
    partials = measures | ({"_sum": total(value, scale)} if mean else {})
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in by], F.lit(True))
    counts = value_counts(df.where(known), by, value, partials)
    out = summarize(counts, by, value, quantiles, partials)
    columns = [F.col(c) for c in [*by, *quantiles]]
    if count:
        columns.append(F.col("_total").alias(count))
    if mean:
        columns.append(mean_of(F.col("_sum"), F.col("_total")).alias(mean))
    return out.select(*columns, *measures)


def summarize(
    counts: DataFrame,
    by: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    measures: Mapping[str, Measure] | None = None,
) -> DataFrame:
    """Groups, ``_total`` rows, merged measures and quantiles from the counts of values.

    ``by`` are some of the columns the values were counted by, or none for the whole table.
    """
    groups = list(by) or ["_all"]
    rows = counts if by else counts.withColumn("_all", F.lit(0))
    rows = rows.withColumn("_cell", value_cell(F.col(value)))
    rows = rows.withColumn("_part", value_part(F.col(value)))
    part = [*groups, "_cell", "_part"]

    merged = {"_rows": F.sum(f"{STATE}._rows")}
    merged |= {k: m.merge(f"{STATE}.{k}") for k, m in (measures or {}).items()}
    parts = rows.groupBy(*part).agg(*[c.alias(k) for k, c in merged.items()])

    # The totals of a group go along with its parts, so they need no join.
    whole = {"_total": F.sum("_rows")} | {k: m.merge(k) for k, m in (measures or {}).items()}
    in_group = Window.partitionBy(*groups)
    upto = F.sum("_rows").over(in_group.orderBy("_cell", "_part")).alias("_upto")
    totals = [c.over(in_group).alias(f"_of_{k}") for k, c in whole.items()]
    placed = parts.select(*part, "_rows", upto, *totals)
    named = [F.col(f"_of_{k}").alias(k) for k in whole]
    placed = placed.select(*part, (F.col("_upto") - F.col("_rows")).alias("_before"), "_upto", *named)

    ranks = {name: _ranks(share) for name, share in quantiles.items()}
    hit = [(r >= F.col("_before")) & (r < F.col("_upto")) for pair in ranks.values() for r in pair]
    wanted = placed.where(reduce(Column.__or__, hit)).drop("_upto")

    # Only the values of the wanted parts are put in order.
    values = rows.select(*part, value, F.col(f"{STATE}._rows").alias("_n")).join(wanted, part)
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*part).orderBy(value))
    ordered = values.withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col("_n"))
    ends = []
    for name, (low, high) in ranks.items():
        for end, rank in (("low", low), ("high", high)):
            here = (rank >= F.col("_from")) & (rank < F.col("_upto"))
            ends.append(F.max(F.when(here, F.col(value))).alias(f"_{name}_{end}"))
    # All rows of a group carry the same totals, any of them will do.
    same = [F.any_value(k).alias(k) for k in whole]
    picked = ordered.groupBy(*groups).agg(*same, *ends)
    points = [
        _between(F.col(f"_{name}_low"), F.col(f"_{name}_high"), share).alias(name)
        for name, share in quantiles.items()
    ]
    return picked.select(*by, *whole, *points)


def _ranks(share: float) -> tuple[Column, Column]:
    position = F.lit(share) * (F.col("_total") - 1)
    return F.floor(position), F.ceil(position)


def _between(low: Column, high: Column, share: float) -> Column:
    """Point between two neighbouring values, computed from the nearer one."""
    if share == 0.5:
        return (low + high) / 2
    position = F.lit(share) * (F.col("_total") - 1)
    part = position - F.floor(position)
    span = high - low
    return F.when(part < 0.5, low + span * part).otherwise(high - span * (1 - part))


def quantile(df: DataFrame, value: str, share: float, name: str) -> DataFrame:
    """Exact quantile of a whole column, one row."""
    return grouped_summary(df, [], value, {name: share})


def up_to_quantile(counts: DataFrame, value: str, share: float) -> DataFrame:
    """The counts of the values that do not exceed the quantile of all rows."""
    limit = summarize(counts, [], value, {"_limit": share})
    return counts.where(F.col(value) <= limit.select("_limit").scalar())


def trim_quantile(df: DataFrame, value: str, share: float) -> DataFrame:
    """Rows whose value does not exceed the quantile."""
    limit = quantile(df.select(value), value, share, "_limit")
    return df.where(F.col(value) <= limit.select("_limit").scalar())
