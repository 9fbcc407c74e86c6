"""Raw files to dashboard tables, and the sinks on the way."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from loticote.operators import star
from loticote.plans import batch
from loticote.session import clear_scratch, materialize, scratch_root
from loticote.sources import readers, writers

HEADER = ["Source", "Titre", "Type d'offre", "Type de bien", "Quartier", "Prix", "Piece", "Surface",
          "Valeur par piece", "Valeur par m2", "source"]
LISTINGS = {
    "immoask": [
        ["X", "Villa, \"neuve\"\nvue mer", "Vente", "Villa", "BE", "5 000 000", "", "100", "", "", "x"],
        ["X", "Villa, \"neuve\"\nvue mer", "VENTE", "Villas", "be", "5000000", "3", "100", "", "", "x"],
        ["X", "Studio", "Location", "Studio meublé", "Agoe", "200000", "1", "50", "", "", "x"],
        ["X", "Terrain", "VENTE", "TERRAIN", "non loin du marché", "1000000", "", "100", "", "", "x"],
    ],
    "facebook": [
        ["Y", "Maison", "VENTE", "3 chambres", "Bè", "12000000", "", "200", "", "", "y"],
        ["Y", "Vide", "VENTE", "Villa", "be", "10", "", "200", "", "", "y"],
    ],
}
OFFICIAL_HEADER = ["Préfecture", "Zone", "Type d'offre", "Type de bien", "Quartier",
                   "Valeur vénale (FCFA)", "Surface (m²)", "Valeur/m² (FCFA)", "source"]
OFFICIAL = [
    ["GOLFE", "ZONE 1", "VENTE", "TERRAIN", "BE", "24000000", "600", "40000", "v"],
    ["GOLFE", "ZONE 1", "VENTE", "TERRAIN", "BE", "30000000", "600", "50000", "v"],
    ["AVE", "ZONE 2", "VENTE", "TERRAIN", "KEVE", "600000", "600", "1000", "v"],
]


def write(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([header, *rows])


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("batch")
    raw = root / "raw"
    raw.mkdir()
    for source, rows in LISTINGS.items():
        write(raw / f"{source}.csv", HEADER, rows)
    write(raw / "valeursvenales.csv", OFFICIAL_HEADER, OFFICIAL)
    path = str(root / "out")
    report = {r.perimetre: r for r in batch.clean(spark, str(raw), path).collect()}
    counts = {r.table_name: r.nb_lignes for r in batch.model(spark, path).collect()}
    batch.measure(spark, path)
    return path, report, counts


def test_clean(spark, out):
    path, report, _ = out
    assert report["immoask"].asDict() == {
        "perimetre": "immoask", "avant": 3, "valides": 2, "rejetes": 1, "taux_rejet": 33.33,
    }
    assert report["TOTAL"].avant == 5
    valid = batch.read_valid(spark, path).orderBy("titre").collect()
    assert [(r.titre, r.type_bien, r.zone, r.pieces, r.source) for r in valid] == [
        ("Maison", "Maison", "bè", 3, "facebook"),
        ("Studio", "Studio", "agoe", 1, "immoask"),
        ("Villa, \"neuve\"\nvue mer", "Villa", "be", None, "immoask"),
    ]
    exported = readers.read_csv_text(spark, f"{path}/annonces")
    assert {r.titre for r in exported.collect()} == {r.titre for r in valid}


def test_model(spark, out):
    _, _, counts = out
    assert counts == {
        "source_donnees": 3, "zone_geographique": 4, "annonce": 3, "bien_immobilier": 3,
        "valeur_venale": 3, "annonces_rejetees": 2, "statistiques_zone": 0, "indice_immobilier": 0,
        "annonces_ignorees": 0, "valeurs_ignorees": 0,
    }


def test_measure_replaces_its_period(spark, out):
    path, _, _ = out
    before = batch.read_statistics(spark, path).count()
    batch.measure(spark, path)
    stats = batch.read_statistics(spark, path)
    assert stats.count() == before == 3
    # 50 000 against the mean of 40 000 and 50 000.
    assert [r.ecart_valeur_venale for r in stats.where("zone = 'be'").collect()] == [11.11]
    stored = writers.read_star_table(spark, f"{path}/etoile", "statistiques_zone")
    # The partition column comes last.
    assert set(stored.dtypes) == {(f.name, f.dataType.simpleString()) for f in writers.STAR["statistiques_zone"]}
    assert stored.count() == 3
    index = writers.read_star_table(spark, f"{path}/etoile", "indice_immobilier")
    assert {float(r.indice_valeur) for r in index.collect()} == {100.0}


def test_dashboard(spark, out):
    path, _, _ = out
    tables = batch.dashboard_tables(spark, path, offer="VENTE")
    sizes = {name: df.count() for name, df in tables.items()}
    assert sizes["kpis"] == 1 and sizes["sources"] == 3 and sizes["dearest"] == 2
    top = tables["dearest"].first()
    assert (top.titre, top.prix_m2) == ("Maison", 60000.0)
    assert {r.zone for r in tables["map"].collect()} == {"be", "bè"}
    assert tables["market_vs_official"].first().prix_venale_m2 == 45000.0


def test_many_official_rows_do_not_multiply_results(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    write(raw / "immoask.csv", HEADER, LISTINGS["immoask"][:3])
    rows = [["GOLFE", "Z", "VENTE", "TERRAIN", "be", "24000000", "600", str(40000 + i), "v"] for i in range(30)]
    rows += [["GOLFE", "Z", "VENTE", "TERRAIN", "loin", "1", "600", "2000000000", "v"]]
    write(raw / "valeursvenales.csv", OFFICIAL_HEADER, rows)
    batch.clean(spark, str(raw), out)
    counts = {r.table_name: r.nb_lignes for r in batch.model(spark, out).collect()}
    assert (counts["valeur_venale"], counts["valeurs_ignorees"]) == (30, 1)
    batch.measure(spark, out)
    assert batch.read_statistics(spark, out).count() == 2
    assert writers.read_star_table(spark, f"{out}/etoile", "indice_immobilier").count() == 2
    batch.measure(spark, out, per_official_row=True, index_keys=("id_zone", "type_bien"))
    assert batch.read_statistics(spark, out).count() == 31
    batch.export_filtered(spark, out, str(tmp_path / "export"), offer="VENTE")
    assert readers.read_csv_text(spark, str(tmp_path / "export" / "annonces")).count() == 1
    # A refresh removes what was computed from the star before it.
    batch.model(spark, out)
    assert batch.read_statistics(spark, out).count() == 0
    assert writers.read_star_table(spark, f"{out}/etoile", "indice_immobilier").count() == 0


def test_skipped_rows_are_kept_with_their_reason(spark):
    listings = spark.createDataFrame(
        [("a", "VENTE", "Villa", "be", 5e6, "3", 100.0, "s"), ("b", None, None, "be", 1e15, "3", 100.0, "s"),
         ("c", None, "Villa", "none", 5e6, "3", 100.0, "s"), ("d", None, None, "be", 5e6, "1.2.3", 1.0, "s"),
         ("e", None, None, "be", 5e6, " 4 ", 100.0, "s")],
        "titre string, type_offre string, type_bien string, zone string, prix double, pieces string, "
        "surface_m2 double, source string",
    )
    zones, sources = star.dim_zone(listings.where("zone = 'be'")), star.dim_source(listings)
    loaded, skipped = star.split_load(star.tag_load(listings, zones, sources))
    assert {r.titre: (r.type_offre, r.type_bien, r.pieces) for r in loaded.collect()} == {
        "a": ("VENTE", "Villa", 3), "e": ("INCONNU", "Inconnu", 4),
    }
    assert {r.titre: r.raison_ignore for r in skipped.collect()} == {
        "b": "valeur_hors_bornes", "c": "zone_inconnue", "d": "pieces_invalides",
    }
    whole = star.tag_load(listings.withColumn("titre", F.lpad("titre", 300, "x")), zones, sources, title_width=None)
    assert {len(r.titre) for r in whole.collect()} == {300}


def test_files_with_other_headers(spark, tmp_path):
    folder = tmp_path / "facebook.csv"
    folder.mkdir()
    write(folder / "1.csv", ["Titre", "Quartier", "Prix"], [["t1", "z1", "1"]])
    write(folder / "2.csv", ["Quartier", "Titre", "Prix"], [["z2", "t2\nx", "2"]])
    write(folder / "3.csv", ["Titre", "Quartier", "Prix", "Surface"], [["t3", "z3", "3", "30"]])
    rows = readers.read_listings(spark, str(folder), "facebook").collect()
    assert sorted((r.Titre, r.Quartier, r.Prix, r.Surface, r.source) for r in rows) == [
        ("t1", "z1", "1", None, "facebook"), ("t2\nx", "z2", "2", None, "facebook"),
        ("t3", "z3", "3", "30", "facebook"),
    ]


def test_scratch_is_cleared(spark):
    kept = materialize(spark.range(3), "test")
    assert kept.count() == 3
    root = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    assert os.listdir(root)
    clear_scratch(spark)
    assert not os.path.exists(root)


def test_missing_source_is_an_empty_table(spark, out, tmp_path):
    from loticote.sources.schemas import RAW_LISTING

    empty = readers.read_if_present(spark, str(tmp_path / "none.csv"), "s", RAW_LISTING)
    assert empty.count() == 0


def test_ingest_writes_one_tagged_file_per_source(spark, tmp_path):
    spark.range(3).withColumn("Prix", F.lit("5")).write.parquet(str(tmp_path / "in"))
    batch.ingest_sources(spark, {"immoask": str(tmp_path / "in")}, "parquet", str(tmp_path / "raw"))
    back = spark.read.parquet(str(tmp_path / "raw" / "immoask"))
    assert back.count() == 3 and set(back.columns) == {"id", "Prix", "source"}


def test_csv_keeps_blanks_quotes_and_breaks(spark, tmp_path):
    rows = [(" a ", 'say "x"'), ("l1\nl2", "c,d"), ("\tt", "é")]
    writers.write_csv(spark.createDataFrame(rows, "u string, v string"), str(tmp_path / "c"))
    back = readers.read_csv_text(spark, str(tmp_path / "c"))
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)
