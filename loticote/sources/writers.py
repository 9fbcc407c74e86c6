"""Sinks: CSV, Parquet, rejects, result tables, full refresh of the star schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loticote.session import materialize
from loticote.sources.readers import plain_text
from loticote.sources.schemas import RESULT_TABLES, STAR
from loticote.sources.versions import Refresh, committed

REFUSED_RESULTS = "resultats_refuses"


def write_csv(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Overwrite a CSV folder, UTF-8 with header; text reads back as written, empty text as NULL."""
    (
        df.write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet folder, whole and not by partition."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_landing(df: DataFrame, path: str) -> None:
    """Overwrite the landed rows of a source: every column as text, files of even size."""
    write_parquet(plain_text(df).hint("rebalance"), path)


def write_rejects(df: DataFrame, path: str) -> None:
    write_parquet(df, path, ["raison_rejet"])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns and types of a star table; columns nothing fills are NULL."""
    columns = [
        (F.col(field.name) if field.name in df.columns else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in STAR[table].fields
    ]
    return df.select(*columns)


def split_results(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows that the columns of a result table can hold, refused ones).

    A refused row is kept as JSON with the names of the columns that cannot hold its values.
    """
    kinds = {f.name: f.dataType for f in STAR[table].fields if f.name in df.columns}
    misfits = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(), F.lit(c)) for c, kind in kinds.items()
    ]
    tagged = df.withColumn("_misfits", F.concat_ws(",", *misfits))
    refused = tagged.where(F.col("_misfits") != "").select(
        F.lit(table).alias("table_name"),
        F.col("_misfits").alias("colonnes"),
        F.to_json(F.struct(*kinds)).alias("ligne"),
        F.col("periode").cast("string").alias("periode"),
    )
    return conform(tagged.where(F.col("_misfits") == ""), table), refused


def partitions_of(name: str) -> list[str]:
    return ["periode"] if name in RESULT_TABLES else []


def refresh_star(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Replace star tables under ``root`` in one commit; returns (table_name, nb_lignes) as written.

    Readers see all new tables or none. The result tables are replaced as well: what was computed from the
    old star goes, unless new rows are given.
    """
    with Refresh(spark, root) as new:
        counts = write_star(new, tables)
        counts |= clear_results(new, tables)
    return count_table(spark, counts)


def write_star(new: Refresh, tables: Mapping[str, DataFrame]) -> dict[str, int]:
    return {name: new.write(name, conform(df, name), partitions_of(name))["rows"] for name, df in tables.items()}


def clear_results(new: Refresh, given: Iterable[str] = ()) -> dict[str, int]:
    """Leave the result tables empty that were not given."""
    stale = [name for name in RESULT_TABLES if name not in given]
    return write_star(new, {name: new.spark.createDataFrame([], STAR[name]) for name in stale})


def write_results(spark: SparkSession, results: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    """Add result rows in one commit; the periods in ``results`` replace their earlier versions, others
    stay. Returns the rows written of each table and ``resultats_refuses``, the rows no column could hold.
    """
    with Refresh(spark, root) as new:
        return write_results_into(new, results)


def write_results_into(new: Refresh, results: Mapping[str, DataFrame]) -> dict[str, int]:
    spark, counts, refusals = new.spark, {}, []
    for name, df in results.items():
        earlier = read_folder(spark, new.path(name), name) if name in new.tables else None
        # Stored as computed, because it is read twice.
        fitting, refused = split_results(materialize(df, name), name)
        counts[name] = new.write(name, fitting, ["periode"])["rows"]
        refusals.append(refused)
        if earlier is not None:
            periods = read_folder(spark, new.path(name), name).select("periode").distinct()
            new.write(name, earlier.join(periods, "periode", "left_anti"), ["periode"])
    refused = reduce(DataFrame.unionByName, refusals)
    counts[REFUSED_RESULTS] = new.write(REFUSED_RESULTS, refused)["rows"]
    return counts


def count_table(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "table_name string, nb_lignes long")


def read_folder(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(STAR[name]).parquet(path)


def read_star_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the newest commit, or the plain folder of its name where nothing was committed."""
    return read_folder(spark, committed(spark, root).get(name, f"{root}/{name}"), name)
