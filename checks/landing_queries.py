"""Many part files with different headers, and sources landed once as text in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from checks.cleaning_queries import CANONICAL, RAW_SELECT, STANDARD, TAGGED, real_rooms
from checks.registry import query
from checks.views import PARAMS, RAW, with_
from loticote.operators import cleaning
from loticote.plans import batch
from loticote.session import materialize, scratch_path
from loticote.sources import readers, writers
from loticote.sources.schemas import RAW_LISTING


@query(
    "scan_many_files",
    with_(RAW)
    + RAW_SELECT.replace(
        '"Surface"', """CASE WHEN l_linenumber <> 3 THEN nullif("Surface", '') END"""
    )
    + ", 'facebook' AS source FROM raw",
)
def scan_many_files(spark: SparkSession, sf: str) -> DataFrame:
    """Part files of at most 400 rows under three headers; one job looks at all headers."""
    path = scratch_path(spark, "many.csv")
    df = materialize(v.raw_listings(spark, sf, "l_linenumber"), "raw")
    first = df.where("l_linenumber NOT IN (2, 3)").drop("l_linenumber")
    kinds = {
        "a": first,
        "b": df.where("l_linenumber = 2").select(*reversed(first.columns)),
        "c": df.where("l_linenumber = 3").drop("Surface", "l_linenumber"),
    }
    for name, part in kinds.items():
        writers.write_csv(part, f"{path}/{name}", rows_per_file=400)
    read = readers.read_listings(spark, [f"{path}/{name}" for name in kinds], "facebook", multiline=False)
    return cleaning.rename_listings(read)


BROKEN_TITLE = """CASE WHEN l_linenumber % 2 = 0 THEN concat(p_name, chr(10), '"', p_name, '", neuf') ELSE p_name END"""


@query(
    "landed_listings",
    with_(RAW.replace("p_name AS \"Titre\"", f"{BROKEN_TITLE} AS \"Titre\""), STANDARD, TAGGED)
    + f"SELECT {CANONICAL}, raison_rejet FROM tagged",
)
def landed_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Titles with quotes and line breaks: parsed from CSV once, landed, then cleaned from the landing."""
    root = scratch_path(spark, "landing")
    raw = v.raw_listings(spark, sf, "l_linenumber", "p_name")
    raw = materialize(raw.withColumn("Titre", F.expr(BROKEN_TITLE)).drop("l_linenumber", "p_name"), "raw")
    names = [row.source for row in raw.select("source").distinct().collect()]
    for name in names:
        writers.write_csv(raw.where(F.col("source") == name), f"{root}/raw/{name}.csv")
    writers.write_csv(v.raw_official(spark, sf), f"{root}/raw/valeursvenales.csv")
    batch.land_files(spark, f"{root}/raw", f"{root}/landed", names)
    landed = [readers.read_landed(spark, f"{root}/landed/{name}", name, RAW_LISTING) for name in names]
    return real_rooms(readers.union_sources([cleaning.tag_listings(df, PARAMS) for df in landed]))
