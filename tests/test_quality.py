"""Rejection rules, de-duplication and reports."""

from pyspark.sql import functions as F

from loticote.operators import cleaning, quality
from loticote.operators.quality import QualityParams

RULE_ROWS = [
    ("z" * 30, 1000.0, 1.0, None),
    ("z" * 31, 1000.0, 1.0, "zone_trop_longue"),
    ("z" * 31, None, 1.0, "zone_trop_longue"),
    ("togo", 5000.0, 1.0, "zone_invalide"),
    ("", 5000.0, 1.0, "zone_invalide"),
    (None, 5000.0, 1.0, "zone_invalide"),
    ("face a la poste", 5000.0, 1.0, "zone_description_lieu"),
    ("non loin", None, 1.0, "zone_description_lieu"),
    ("be", None, 1.0, "prix_ou_surface_manquant"),
    ("be", 5000.0, None, "prix_ou_surface_manquant"),
    ("be", 1000.0, 1.0, None),
    ("be", 999.99, 1.0, "prix_m2_trop_bas"),
    ("be", 2000000.0, 1.0, None),
    ("be", 2000000.01, 1.0, "prix_m2_trop_eleve"),
    ("be", 5.0, 0.0, None),
    ("be", 5.0, -1.0, None),
]


def rules(spark):
    return spark.createDataFrame(RULE_ROWS, "zone string, prix double, surface_m2 double, e string")


def test_each_rule_and_their_priority(spark):
    tagged = quality.tag_reasons(rules(spark))
    wrong = tagged.where(~F.col("raison_rejet").eqNullSafe(F.col("e"))).collect()
    assert wrong == []


def test_null_zone_policy(spark):
    kept = quality.tag_reasons(rules(spark), QualityParams(reject_null_zone=False))
    row = kept.where("zone IS NULL").first()
    assert row.raison_rejet is None


def test_split_keeps_every_row(spark):
    valid, rejected = quality.split(quality.tag_reasons(rules(spark)))
    assert valid.count() + rejected.count() == len(RULE_ROWS)
    assert "raison_rejet" not in valid.columns


def listings(spark, rows):
    return spark.createDataFrame(
        rows, "source string, titre string, prix double, zone string, surface_m2 double, type string"
    )


def test_duplicates(spark):
    rows = [
        ("a", "t", 1.0, "be", 5.0, "Villa"),
        ("a", "t", 1.0, "be", 5.0, "Appartement"),
        ("b", "t", 1.0, "be", 5.0, "Villa"),
        ("a", None, 1.0, "be", 5.0, "Villa"),
        ("a", None, 1.0, "be", 5.0, None),
        ("a", "t", 1.0, "be", 6.0, "Villa"),
    ]
    got = quality.drop_duplicates(listings(spark, rows)).collect()
    assert sorted((r.source, r.titre or "", r.surface_m2, r.type or "") for r in got) == [
        ("a", "", 5.0, ""), ("a", "t", 5.0, "Appartement"), ("a", "t", 6.0, "Villa"),
        ("b", "t", 5.0, "Villa"),
    ]
    assert quality.drop_duplicates_v1(listings(spark, rows)).count() == 3


def test_copies_are_dropped_before_the_shuffle(spark):
    df = listings(spark, [("a", "t", 1.0, "be", 5.0, "Villa")])
    plan = quality.drop_duplicates(df)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_quality_summary(spark):
    rows = [("a", "t", 1.0, "be", 5.0, None)] * 3 + [("a", "t", 1.0, "be", 5.0, "trop_bas")] * 2
    rows += [("b", "t", 1.0, "be", 5.0, None), ("b", "u", 1.0, "be", 5.0, None)]
    tagged = listings(spark, rows).withColumnRenamed("type", "raison_rejet")
    got = {r.perimetre: r for r in quality.quality_summary(tagged).collect()}
    assert (got["a"].avant, got["a"].valides, got["a"].rejetes, got["a"].taux_rejet) == (3, 1, 2, 66.67)
    assert (got["TOTAL"].avant, got["TOTAL"].valides, got["TOTAL"].rejetes) == (5, 3, 2)


def test_missing_profile(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", "x", 1), ("a", "y", None), ("b", "z", 2)], "source string, u string, v int"
    )
    got = {(r.source, r.colonne): (r.manquants, r.pourcentage) for r in quality.missing_profile(df, "source").collect()}
    assert got == {("a", "u"): (1, 33.3), ("a", "v"): (1, 33.3)}


def test_raw_listing_end_to_end(spark):
    raw = spark.createDataFrame(
        [
            ("IMMO", "Titre 1", " Vente ", "2 chambres", " Bè\t", "1 500 000 FCFA", None, "100"),
            ("IMMO", "Titre 2", "LOCATION", "Loft", "togo", "1000", "3", "1"),
        ],
        "Source string, Titre string, `Type d'offre` string, `Type de bien` string, "
        "Quartier string, Prix string, Piece string, Surface string",
    ).withColumnRenamed("Source", "Source0").withColumn("source", F.lit("immoask"))
    valid, rejected = cleaning.clean_listings(raw)
    row = valid.first()
    assert row.asDict() == {
        "titre": "Titre 1", "type_offre": "VENTE", "type_bien": "Maison", "zone": "bè",
        "prix": 1500000.0, "pieces": 2, "surface_m2": 100.0, "source": "immoask",
    }
    assert [r.raison_rejet for r in rejected.collect()] == ["zone_invalide"]


def test_v1_rules(spark):
    raw = spark.createDataFrame(
        [("t", "be", "5", "1"), ("t", "be", "5", "2"), ("t", "Non spécifié", "5", "1"),
         ("t", None, "5", "1"), ("t", "be", "0", "1"), ("u", "be", "5", None)],
        "Titre string, Quartier string, Prix string, Surface string",
    ).withColumn("source", F.lit("s"))
    got = cleaning.clean_listings_v1(raw).collect()
    assert [(r.titre, r.zone, r.surface_m2) for r in got] == [("t", "be", 1.0)]
