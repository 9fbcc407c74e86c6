"""Header discovery over many files, and the landing table behind it."""

import os

import pytest
from pyspark.sql import functions as F
from test_batch import HEADER, LISTINGS, OFFICIAL, OFFICIAL_HEADER, write

from loticote.plans import batch
from loticote.sources import readers, writers


class Jobs:
    """Counts the jobs of a job group."""

    def __init__(self, spark):
        self.context, self.name = spark.sparkContext, f"jobs-{os.urandom(4).hex()}"

    def __enter__(self):
        self.context.setJobGroup(self.name, self.name)
        return self

    def __exit__(self, *_):
        self.context._jsc.clearJobGroup()

    def count(self):
        return len(self.context.statusTracker().getJobIdsForGroup(self.name))


def test_many_part_files_in_one_scan(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    orders = [["Titre", "Prix", "Quartier"], ["Prix", "Quartier", "Titre"], ["Titre", "Quartier"]]
    want = []
    for i in range(400):
        row = {"Titre": f"t{i}", "Prix": str(i), "Quartier": "a\nb"}
        columns = orders[i % 3]
        write(folder / f"{i}.csv", columns, [[row[c] for c in columns]])
        want.append((row["Titre"], row["Prix"] if i % 3 < 2 else None, row["Quartier"]))
    write(folder / "short.csv", ["Titre", "Prix", "Quartier"], [])
    (folder / "empty.csv").write_text("")
    with Jobs(spark) as jobs:
        df = readers.read_csv_text(spark, str(folder))
        # Stages of the adaptive plan count as jobs; their number does not depend on the files.
        assert jobs.count() <= 5
    rows = df.select("Titre", "Prix", "Quartier").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)


def test_header_with_line_breaks_and_doubles(spark, tmp_path):
    path = tmp_path / "x.csv"
    with open(path, "w", newline="", encoding="utf-8") as out:
        out.write('\n"Prix\n(FCFA)",Titre,"say ""x""",,titre\n1,"a\nb",c,d,e\n')
    [(fields, files)] = readers.files_by_header(spark, str(path))
    assert fields == ["Prix\n(FCFA)", "Titre", 'say "x"', "", "titre"] and len(files) == 1
    df = readers.read_csv_text(spark, str(path))
    assert df.columns == ["Prix\n(FCFA)", "Titre1", 'say "x"', "_c3", "titre4"]
    assert [tuple(r) for r in df.collect()] == [("1", "a\nb", "c", "d", "e")]


@pytest.mark.parametrize("header", [["Source", "x", "source"], ["a", "", "A", "b"], ["x"]])
def test_names_are_those_of_spark(spark, tmp_path, header):
    path = tmp_path / "h.csv"
    write(path, header, [[str(i) for i in range(len(header))]])
    assert readers.header_schema(header).names == spark.read.option("header", True).csv(str(path)).columns


def test_folder_without_content(spark, tmp_path):
    folder = tmp_path / "none"
    folder.mkdir()
    (folder / "a.csv").write_text("")
    assert readers.read_csv_text(spark, str(folder)).count() == 0


def test_settings_of_the_caller_stay(spark, tmp_path):
    write(tmp_path / "a.csv", ["x"], [["1"]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    readers.read_csv_text(spark, str(tmp_path / "a.csv")).collect()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_numbers_land_without_exponent(spark, tmp_path):
    rows = [(12_000_000.0, 1.5e9, 3, [1, 2]), (0.25, 12345678.25, None, None), (-3.0, 1e-5, 7, [])]
    df = spark.createDataFrame(rows, "Prix double, q double, n long, xs array<int>")
    writers.write_landing(df, str(tmp_path / "l"))
    back = spark.read.parquet(str(tmp_path / "l"))
    assert {t for _, t in back.dtypes} == {"string"}
    got = {(r.Prix, r.q, r.n, r.xs) for r in back.collect()}
    assert got == {("12000000", "1500000000", "3", "[1,2]"), ("0.25", "12345678.25", None, None), ("-3", "1.0E-5", "7", "[]")}


def test_landed_sources_are_cleaned_like_files(spark, tmp_path):
    raw, landing = tmp_path / "raw", tmp_path / "landing"
    raw.mkdir()
    for source, rows in LISTINGS.items():
        write(raw / f"{source}.csv", HEADER, rows)
    write(raw / "valeursvenales.csv", OFFICIAL_HEADER, OFFICIAL)
    batch.land_files(spark, str(raw), str(landing))
    one = batch.clean(spark, str(raw), str(tmp_path / "one")).collect()
    two = batch.clean(spark, str(landing), str(tmp_path / "two"), landed=True).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))
    titles = [r.titre for r in batch.read_valid(spark, str(tmp_path / "two")).collect()]
    assert any("\n" in t for t in titles)
    assert spark.read.parquet(str(landing / "immoask")).where(F.col("Titre").contains("\n")).count() == 2


class Tasks(Jobs):
    """Counts the tasks as well."""

    def count(self):
        status = self.context.statusTracker()
        jobs = [status.getJobInfo(j) for j in status.getJobIdsForGroup(self.name)]
        stages = {s for job in jobs for s in job.stageIds}
        return sum(info.numTasks for info in map(status.getStageInfo, stages) if info)


def test_small_files_share_tasks(spark, tmp_path):
    orders = {"a": ["Titre", "Prix"], "b": ["Prix", "Titre"]}
    want = []
    for name, columns in orders.items():
        (tmp_path / name).mkdir()
        for i in range(300):
            row = {"Titre": f"{name}{i}", "Prix": str(i)}
            write(tmp_path / name / f"{i}.csv", columns, [[row[c] for c in columns]])
            want.append((row["Titre"], row["Prix"]))
    paths = [str(tmp_path / name) for name in orders]
    with Tasks(spark) as tasks:
        groups = readers.files_by_header(spark, paths)
        assert tasks.count() < 150
    assert [(fields, len(files)) for fields, files in groups] == [(sorted(orders["b"]), 300), (orders["a"], 300)]
    df = readers.read_csv_text(spark, paths, multiline=False)
    assert sorted(map(tuple, df.select("Titre", "Prix").collect())) == sorted(want)


@pytest.mark.parametrize("size", [0, 1 << 20])
@pytest.mark.parametrize(
    "head, fields",
    [
        ('a"b,"x\ny"\n1,2\n', ['a"b', "x\ny"]),
        ('\r\n\r\n"a ""q"", b"c"d,e\r\n"1\n', ['a "q", bc"d', "e"]),
        ('"never closed,\nb\n1', ["never closed,\nb\n1\n"]),
        (",\n1,2\n", ["", ""]),
        ("x", ["x"]),
        ("\n\n", None),
    ],
)
def test_headers_of_small_and_large_files(spark, tmp_path, monkeypatch, size, head, fields):
    monkeypatch.setattr(readers, "SMALL_FILE", size)
    (tmp_path / "x.csv").write_bytes(head.encode())
    got = readers.files_by_header(spark, str(tmp_path))
    assert [f for f, _ in got] == ([] if fields is None else [fields])


def test_a_folder_stands_for_its_files_only_where_it_was_asked_for():
    a, b = [f"file:///r/a/{i}.csv" for i in range(3)], ["file:///r/b/0.csv", "file:///r/b/c/1.csv"]
    assert readers.places(a, b, ["/r/a", "/r/b/"]) == ["file:///r/a"]
    assert readers.places(b, a, ["/r/a", "/r/b/"]) == ["file:///r/b"]
    assert readers.places(a, b, "/r") == a
    assert readers.places(a[:2], [a[2], *b], ["/r/a", "/r/b"]) == a[:2]
    assert readers.places(a[:1], b[:1], ["/r/a/0.csv", "/r/b/0.csv"]) == a[:1]
