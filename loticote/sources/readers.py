"""Sources: raw CSV listings and official values, tagged ingestion, union of sources."""

from __future__ import annotations

import csv
import logging
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    FloatType,
    MapType,
    StringType,
    StructField,
    StructType,
)

log = logging.getLogger(__name__)

# A file may carry both ``Source`` and ``source``. Column names ignore case, so Spark numbers the
# two; both are dropped and the source is set from the file that is read.
SOURCE_HEADER = re.compile(r"^source\d*$", re.IGNORECASE)

# Larger than any file: one task then gets one whole file, however small.
ONE_FILE = 1 << 50

# Files up to this size are looked at many to a task, larger ones in a task each.
SMALL_FILE = 1 << 20
SMALL_FILE_COST = 256 << 10

# The first record that has any content, as Python's csv module ends it: quotes count at the start of a field only.
FIELD = r'(?:"(?:[^"]++|"")*+(?:"[^,\r\n]*+)?|[^,\r\n]*+)'
FIRST_RECORD = rf"\A[\r\n]*+({FIELD}(?:,{FIELD})*+)"
LINE_BREAK = re.compile("\r\n|\r|\n")


def _csv_text(
    spark: SparkSession,
    path: str | list[str],
    multiline: bool,
    columns: StructType | None = None,
    recursive: bool = False,
) -> DataFrame:
    reader = spark.read if columns is None else spark.read.schema(columns)
    return (
        reader.option("header", True)
        .option("recursiveFileLookup", recursive)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )


def _first_record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The header of the one file of a task; the rest of the file is not read."""
    file = None

    def lines() -> Iterator[str]:
        nonlocal file
        for batch in batches:
            for line, path in zip(batch.column("value"), batch.column("file")):
                file = path.as_py()
                yield line.as_py() + "\n"

    for record in csv.reader(lines(), quotechar='"', doublequote=True):
        if record:
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([record])], names=["file", "header"])
            return


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The header of every file from the text of its first record."""
    for batch in batches:
        files, headers = [], []
        for text, path in zip(batch.column("value").to_pylist(), batch.column("file").to_pylist()):
            lines = (line + "\n" for line in LINE_BREAK.split(text))
            record = next(filter(None, csv.reader(lines, quotechar='"', doublequote=True)), None)
            if record:
                files.append(path)
                headers.append(record)
        yield pa.RecordBatch.from_arrays(
            [pa.array(files, pa.string()), pa.array(headers, pa.list_(pa.string()))], names=["file", "header"]
        )


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, header): the fields of the first record of every file that has one.

    One job, however many files there are. Small files come whole, many to a task, and leave Spark's reader
    as their first record; every larger file is one task, which ends after the first record, a header with quoted
    line breaks included. So tasks grow with the bytes and not with the number of files. The settings that give
    files to tasks are those of sessions of their own, so the caller's stay as they are.
    """
    columns = "file string, header array<string>"
    size, file = F.col("_metadata.file_size"), F.col("_metadata.file_path").alias("file")

    many = spark.newSession()
    many.conf.set("spark.sql.files.openCostInBytes", str(SMALL_FILE_COST))
    texts = many.read.text(path, wholetext=True).where(size <= SMALL_FILE)
    first = texts.select(F.regexp_extract("value", FIRST_RECORD, 1).alias("value"), file)
    small = first.mapInArrow(_records, columns)

    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(ONE_FILE))
    own.conf.set("spark.sql.files.openCostInBytes", str(ONE_FILE))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    lines = own.read.text(path).where(size > SMALL_FILE).select("value", file)
    return small.unionByName(lines.mapInArrow(_first_record, columns))


def files_by_header(spark: SparkSession, path: str | list[str]) -> list[tuple[list[str], list[str]]]:
    """The files of a folder or list, grouped by their header: (column names, files)."""
    found = file_headers(spark, path).groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return sorted((list(row.header), list(row.files)) for row in found.collect())


def _folders_above(file: str) -> Iterator[str]:
    while "/" in file:
        file = file.rpartition("/")[0]
        yield file


def places(files: Sequence[str], others: Iterable[str], path: str | list[str]) -> list[str]:
    """The files, or in place of its files a folder in ``path`` that has none of ``others`` anywhere in it.

    A folder is listed once; every file that is named is looked up by itself.
    """
    roots = {urlsplit(p).path.rstrip("/") for p in ([path] if isinstance(path, str) else path)}
    mixed = {folder for file in others for folder in _folders_above(file)}
    chosen = set()
    for file in files:
        asked = [f for f in _folders_above(file) if f not in mixed and urlsplit(f).path in roots]
        chosen.add(asked[-1] if asked else file)
    return sorted(chosen)


def header_schema(fields: Sequence[str]) -> StructType:
    """Text columns named as Spark names them: an empty name and names that differ only in case get
    their place."""
    lower = [f.lower() for f in fields]
    names = [
        f"_c{i}" if not f else f"{f}{i}" if lower.count(f.lower()) > 1 else f for i, f in enumerate(fields)
    ]
    return StructType([StructField(name, StringType()) for name in names])


def read_csv_text(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """CSV with a header, every column as text; a folder of part files is read as one table.

    Columns are matched by name: files with another order of columns are read under their own
    header, and a column that a file lacks is NULL in its rows. Files without any content add
    nothing. Nothing is inferred: inference costs a pass over the files and turns large prices into
    ``1.2E7``. An empty field is NULL. Quoted line breaks need ``multiline``, which parses each
    file in one task; ``batch.land_files`` does this once and stores what it finds in a form that splits.
    """
    groups = files_by_header(spark, path)
    if not groups:
        return _csv_text(spark, path, multiline)
    if len(groups) == 1:  # the folder itself, not the list of its files
        return _csv_text(spark, path, multiline, header_schema(groups[0][0]))
    tables = []
    for fields, files in groups:
        others = [file for _, group in groups if group is not files for file in group]
        found = places(files, others, path)
        tables.append(_csv_text(spark, found, multiline, header_schema(fields), recursive=True))
    return union_sources(tables)


def read_listings(
    spark: SparkSession, path: str | list[str], source: str, multiline: bool = True
) -> DataFrame:
    """Raw listings of one source; rows of files that cannot be split are shared out by size."""
    raw = read_csv_text(spark, path, multiline)
    raw = raw.hint("rebalance") if multiline else raw
    named = raw.drop(*[name for name in raw.columns if SOURCE_HEADER.match(name)])
    return named.withColumn("source", F.lit(source))


def read_official(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """Raw official land values."""
    raw = read_csv_text(spark, path, multiline)
    return raw.drop(*[name for name in raw.columns if SOURCE_HEADER.match(name)])


def read_if_present(
    spark: SparkSession, path: str, source: str, schema: StructType, multiline: bool = True
) -> DataFrame:
    """Listings of a source, or an empty table (and a warning) when its file is missing."""
    try:
        return read_listings(spark, path, source, multiline)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no file for source %s at %s", source, path)
        return spark.createDataFrame([], schema)


def ingest(
    spark: SparkSession, path: str | list[str], fmt: str, source: str, **options: str
) -> DataFrame:
    """Read a source file in any Spark format and tag its rows with the source name."""
    return spark.read.format(fmt).options(**options).load(path).withColumn("source", F.lit(source))


def plain_text(df: DataFrame) -> DataFrame:
    """Every column as text, nested ones as JSON. Fractional numbers are written out without an exponent,
    which the price cleaning would read as further digits."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name.replace('`', '``')}`")
        if isinstance(field.dataType, (FloatType, DoubleType)):
            written = F.regexp_replace(col.try_cast("decimal(38,10)").cast("string"), r"\.?0+$", "")
            text = F.when(F.abs(col) >= 1e7, written).otherwise(col.cast("string"))
            text = F.when(col == F.floor(col), col.try_cast("decimal(38,0)").cast("string")).otherwise(text)
        elif isinstance(field.dataType, (StructType, ArrayType, MapType)):
            text = F.to_json(col)
        else:
            text = col.cast("string")
        columns.append(text.alias(field.name))
    return df.select(*columns)


def read_landed(spark: SparkSession, path: str, source: str, schema: StructType) -> DataFrame:
    """Landed rows of a source; none (and a warning) when nothing was landed."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("nothing landed for source %s at %s", source, path)
        return spark.createDataFrame([], schema)


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; a column missing in one source is NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
