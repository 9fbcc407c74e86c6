"""Versions of a folder of tables: new tables are written beside those in use and taken into use all at once.

A commit is one small file that names the folder of every table. Readers follow the newest commit, so
a refresh that fails halfway leaves them with the tables they had. Folders of the last commits stay, for readers
that have started on them.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS = "_commits"
VERSIONS = "_versions"


class _Folder:
    """The few file operations a commit needs, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.path = path
        self.fs = self.at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        if not self.fs.exists(self.at()):
            return []
        return sorted(status.getPath().getName() for status in self.fs.listStatus(self.at()))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """The file appears whole or not at all; one that is there already is not replaced."""
        hidden = f".{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.at(hidden), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self.at(name)) or not self.fs.rename(self.at(hidden), self.at(name)):
            self.fs.delete(self.at(hidden), False)
            raise RuntimeError(f"{self.path}/{name} was committed by another refresh meanwhile")

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _commits(folder: _Folder) -> list[str]:
    return [name for name in folder.names() if name.endswith(".json") and not name.startswith(".")]


def committed(spark: SparkSession, root: str) -> dict[str, str]:
    """The folder of every table of the newest commit; none when nothing was committed."""
    folder = _Folder(spark, f"{root}/{COMMITS}")
    names = _commits(folder)
    return {t: f"{root}/{path}" for t, path in json.loads(folder.read(names[-1])).items()} if names else {}


class Refresh:
    """``with Refresh(spark, root) as new: new.write(...)`` commits what was written when the block ends.

    Tables that are not written keep their folder. After an exception nothing is committed and the
    new folders are deleted. Of two refreshes at the same time the one that ends later fails.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.folder = _Folder(spark, f"{root}/{COMMITS}")
        names = _commits(self.folder)
        self.number = int(names[-1].split(".")[0]) + 1 if names else 1
        self.tables: dict[str, str] = json.loads(self.folder.read(names[-1])) if names else {}
        self.version = f"{VERSIONS}/{self.number:012d}-{uuid.uuid4().hex[:8]}"
        self.written: list[str] = []

    def __enter__(self) -> Refresh:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.folder.write_new(f"{self.number:012d}.json", json.dumps(self.tables))
        else:
            _Folder(self.spark, self.root).delete(self.version)

    def path(self, name: str) -> str:
        """The folder of a table as this refresh sees it: its own version, else the committed one."""
        return f"{self.root}/{self.tables[name]}"

    def place(self, name: str, suffix: str = "") -> str:
        """Give a table a folder in the new version."""
        self.tables[name] = f"{self.version}/{name}{suffix}"
        return self.path(name)

    def write(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        counts: Mapping[str, Column] | None = None,
    ) -> dict[str, int]:
        """Write a table into the new version; returns its rows (``rows``) and further ``counts``.

        The numbers are taken while the rows are written, so that nothing is read again for them.
        """
        metrics = {"rows": F.count(F.lit(1))} | dict(counts or {})
        observation = Observation(f"{name}-{uuid.uuid4().hex}")
        observed = df.observe(observation, *(c.alias(k) for k, c in metrics.items()))
        self.place(name)
        mode = "append" if name in self.written else "overwrite"
        self.written.append(name)
        (
            observed.write.mode(mode)
            .option("partitionOverwriteMode", "static")
            .partitionBy(*partition_by)
            .parquet(self.path(name))
        )
        found = observation.get
        return {k: int(found.get(k) or 0) for k in metrics}


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write rows in ``buckets`` files by the hash of ``keys``, each in the order of the keys."""
    spark, name = df.sparkSession, f"loticote_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *keys)
        .write.format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # the files stay


def read_buckets(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """Read what ``write_buckets`` has written; joins and groups by the keys then need no shuffle.

    The table is declared in the catalog of the session, which need not outlive it.
    """
    name = f"loticote_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def prune(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete commits but the newest ``keep``, and version folders that none of these names."""
    commits = _Folder(spark, f"{root}/{COMMITS}")
    names = _commits(commits)
    used = {path.split("/")[1] for name in names[-keep:] for path in json.loads(commits.read(name)).values()}
    for name in names[:-keep]:
        commits.delete(name)
    versions = _Folder(spark, f"{root}/{VERSIONS}")
    newest = int(names[-1].split(".")[0]) if names else 0
    for version in versions.names():
        # A later number belongs to a refresh that is still being written.
        if version not in used and int(version.split("-")[0]) <= newest:
            versions.delete(version)
