"""Sources, sinks, column standardisation, quality rules, de-duplication, quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from checks.registry import query
from checks.views import LISTINGS, PARAMS, RAW, RAW_VALUES, exact_round, percent, strip, with_
from loticote.functions import fixed_values as fixed
from loticote.functions import numbers, text
from loticote.operators import cleaning, profiles, quality
from loticote.operators.quality import QualityParams
from loticote.session import materialize, scratch_path
from loticote.sources import readers, writers

# --- SQL building blocks ----------------------------------------------------------------------


def values(table: dict[str, str]) -> str:
    rows = ", ".join("('{}', '{}')".format(k.replace("'", "''"), w) for k, w in table.items())
    return f"(VALUES {rows}) AS t(k, w)"


def looked_up(key: str, table: dict[str, str]) -> str:
    return f"(SELECT w FROM {values(table)} WHERE k = {key})"


def initcap(x: str) -> str:
    word = "lambda w: upper(left(w, 1)) || lower(substr(w, 2))"
    return f"array_to_string(list_transform(string_split({x}, ' '), {word}), ' ')"


def title(x: str) -> str:
    word = "lambda w: upper(left(w, 1)) || lower(substr(w, 2))"
    runs = rf"regexp_extract_all({x}, '(\p{{L}}+|[^\p{{L}}]+)')"
    return f"array_to_string(list_transform({runs}, {word}), '')"


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def to_number(x: str) -> str:
    return f"CASE WHEN regexp_matches({strip(x)}, '{NUMBER}') THEN TRY_CAST({strip(x)} AS DOUBLE) END"


def clean_price(x: str) -> str:
    return rf"TRY_CAST(regexp_replace({x}, '[^0-9.]', '', 'g') AS DOUBLE)"


def rooms_from_type(x: str) -> str:
    found = rf"regexp_extract(lower({strip(x)}), '^([0-9]+)\s*chambre', 1)"
    return f"TRY_CAST({found} AS INTEGER)"


def parse_rooms(x: str) -> str:
    return (
        rf"CASE WHEN regexp_matches({strip(x)}, '^\.*[0-9][0-9.]*$') "
        rf"THEN CAST(trunc(TRY_CAST({strip(x)} AS DOUBLE)) AS INTEGER) END"
    )


def reason(zone: str, price: str, surface: str, params: QualityParams = PARAMS) -> str:
    words = " OR ".join(f"contains(lower({zone}), '{w}')" for w in params.suspicious_words)
    invalid = ", ".join(f"'{z}'" for z in params.invalid_zones)
    ratio = f"CASE WHEN {surface} > 0 THEN {price} / {surface} END"
    return f"""CASE WHEN length({zone}) > {params.zone_max_length} THEN 'zone_trop_longue'
        WHEN {zone} IS NULL OR lower({zone}) IN ({invalid}) THEN 'zone_invalide'
        WHEN {words} THEN 'zone_description_lieu'
        WHEN {price} IS NULL OR {surface} IS NULL THEN 'prix_ou_surface_manquant'
        WHEN {ratio} > {params.price_m2_max} THEN 'prix_m2_trop_eleve'
        WHEN {ratio} < {params.price_m2_min} THEN 'prix_m2_trop_bas' END"""


TYPE_KEY = f"lower({strip('''"Type de bien"''')})"
ROOMS = parse_rooms('"Piece"')
STATED_ROOMS = f"CAST(trunc({to_number('"Piece"')}) AS INTEGER)"
ROOMS_IN_TYPE = rooms_from_type('"Type de bien"')
STANDARD = f"""types AS (SELECT * FROM {values(fixed.PROPERTY_TYPES)}),
standard AS (SELECT "Titre" AS titre, upper({strip('''"Type d'offre"''')}) AS type_offre,
    coalesce(types.w, {initcap(TYPE_KEY)}) AS type_bien,
    lower({strip('"Quartier"')}) AS zone, {clean_price('"Prix"')} AS prix,
    coalesce({STATED_ROOMS}, CASE WHEN {ROOMS_IN_TYPE} > 0 THEN {ROOMS_IN_TYPE} END) AS pieces,
    {to_number('"Surface"')} AS surface_m2, source
    FROM raw LEFT JOIN types ON types.k = {TYPE_KEY})"""
TAGGED = f"tagged AS (SELECT *, {reason('zone', 'prix', 'surface_m2')} AS raison_rejet FROM standard)"
ORDER = "type_offre NULLS FIRST, type_bien NULLS FIRST, pieces NULLS FIRST"
VALID = f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY source, titre, prix, zone,
    surface_m2 ORDER BY {ORDER}) AS place FROM tagged WHERE raison_rejet IS NULL),
valid AS (SELECT titre, type_offre, type_bien, zone, prix, pieces, surface_m2, source
    FROM numbered WHERE place = 1)"""
CLEAN = with_(RAW, STANDARD, TAGGED, VALID)

CANONICAL = """titre, type_offre, type_bien, zone, prix, CAST(pieces AS DOUBLE) AS pieces,
    surface_m2, source"""


def real_rooms(df: DataFrame) -> DataFrame:
    """A nullable whole number has no common form in the compared results, a double has."""
    return df.withColumn("pieces", F.col("pieces").cast("double"))


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.tag_listings(v.raw_listings(spark, sf), PARAMS)


def stored(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.store_tagged(v.raw_listings(spark, sf), PARAMS)


def cleaned(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected listings, both from rows that are tagged and stored once."""
    return cleaning.clean_listings(v.raw_listings(spark, sf), PARAMS)


def valid(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf)[0]


# --- sources ----------------------------------------------------------------------------------

RAW_SELECT = """SELECT "Titre" AS titre, "Type d'offre" AS type_offre, "Type de bien" AS type_bien,
    "Quartier" AS zone, "Prix" AS prix, "Piece" AS pieces, "Surface" AS surface_m2"""


# An empty field of a CSV file is read as NULL.
@query(
    "scan_listings",
    with_(RAW)
    + RAW_SELECT.replace('"Surface"', """nullif("Surface", '')""")
    + ", 'facebook' AS source FROM raw",
)
def scan_listings(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "facebook.csv")
    writers.write_csv(v.raw_listings(spark, sf), path)
    return cleaning.rename_listings(readers.read_listings(spark, path, "facebook"))


@query(
    "scan_mixed_headers",
    with_(RAW)
    + RAW_SELECT.replace(
        '"Surface"', """CASE WHEN l_linenumber <> 3 THEN nullif("Surface", '') END"""
    )
    + ", 'facebook' AS source FROM raw",
)
def scan_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Part files of one folder: another order of columns, and one column missing."""
    path = scratch_path(spark, "mixed.csv")
    df = materialize(v.raw_listings(spark, sf, "l_linenumber"), "raw")
    first = df.where("l_linenumber NOT IN (2, 3)").drop("l_linenumber")
    writers.write_csv(first, f"{path}/a")
    writers.write_csv(df.where("l_linenumber = 2").select(*reversed(first.columns)), f"{path}/b")
    writers.write_csv(df.where("l_linenumber = 3").drop("Surface", "l_linenumber"), f"{path}/c")
    read = readers.read_listings(spark, [f"{path}/{x}" for x in "abc"], "facebook")
    return cleaning.rename_listings(read)


@query(
    "scan_official",
    with_(RAW_VALUES)
    + """SELECT "Préfecture" AS prefecture, "Zone" AS zone_admin, "Type d'offre" AS type_offre,
    "Type de bien" AS type_bien, "Quartier" AS zone, "Valeur vénale (FCFA)" AS prix,
    "Surface (m²)" AS surface_m2, "Valeur/m² (FCFA)" AS prix_m2_officiel FROM raw_values""",
)
def scan_official(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "valeursvenales.csv")
    writers.write_csv(v.raw_official(spark, sf), path)
    names = {"Type d'offre": "type_offre", "Type de bien": "type_bien"}
    df = readers.read_official(spark, path)
    return cleaning.rename_official(df).withColumnsRenamed(names)


SOURCES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(
    "union_sources",
    with_(LISTINGS)
    + """SELECT titre, zone, prix, CASE WHEN source = '2-HIGH' THEN NULL ELSE surface_m2 END
    AS surface_m2, source FROM listings
    WHERE source IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')""",
)
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    df = materialize(v.listings(spark, sf, "titre", "zone", "prix", "surface_m2", "source"), "listings")
    frames = {name: df.where(F.col("source") == name) for name in SOURCES}
    frames["2-HIGH"] = frames["2-HIGH"].drop("surface_m2")
    absent = readers.read_if_present(
        spark, scratch_path(spark, "absent"), "absent", df.schema
    )
    return readers.union_sources([*frames.values(), absent])


@query(
    "ingest_tagged",
    """SELECT c_custkey, c_name, c_acctbal, 'immoask' AS source FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'facebook' FROM supplier""",
)
def ingest_tagged(spark: SparkSession, sf: str) -> DataFrame:
    first = readers.ingest(spark, f"{sf}/customer.parquet", "parquet", "immoask")
    path = scratch_path(spark, "supplier.json")
    v.table(spark, sf, "supplier").write.json(path)
    second = readers.ingest(
        spark, path, "json", "facebook", primitivesAsString="true"
    ).select(
        F.col("s_suppkey").cast("bigint").alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_acctbal").cast("double").alias("c_acctbal"),
        "source",
    )
    columns = ["c_custkey", "c_name", "c_acctbal", "source"]
    return first.select(*columns).unionByName(second)


@query(
    "source_overview",
    with_(LISTINGS)
    + """SELECT source, count(*) AS nb_lignes, 5 AS nb_colonnes FROM listings GROUP BY source""",
)
def source_overview(spark: SparkSession, sf: str) -> DataFrame:
    df = v.listings(spark, sf, "prix", "surface_m2", "type_offre", "prix_m2", "source")
    return profiles.source_overview(df)


@query(
    "preview",
    with_(LISTINGS)
    + "SELECT titre, zone, prix FROM listings ORDER BY prix, titre, zone LIMIT 20",
)
def preview(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.preview(v.listings(spark, sf, "titre", "zone", "prix"), 20, ["prix", "titre", "zone"])


# --- sinks ------------------------------------------------------------------------------------

LISTING_ROWS = "SELECT titre, zone, type_bien, type_offre, prix, surface_m2 FROM listings"


@query("roundtrip_csv", with_(LISTINGS) + LISTING_ROWS)
def roundtrip_csv(spark: SparkSession, sf: str) -> DataFrame:
    df = v.listings(spark, sf, "titre", "zone", "type_bien", "type_offre", "prix", "surface_m2")
    path = scratch_path(spark, "export.csv")
    writers.write_csv(df, path)
    back = readers.read_csv_text(spark, path, multiline=False)
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in df.schema.fields])


@query("roundtrip_parquet", with_(LISTINGS) + LISTING_ROWS)
def roundtrip_parquet(spark: SparkSession, sf: str) -> DataFrame:
    df = v.listings(spark, sf, "titre", "zone", "type_bien", "type_offre", "prix", "surface_m2")
    path = scratch_path(spark, "export")
    writers.write_parquet(df, path, ["type_offre"])
    return spark.read.schema(df.schema).parquet(path)


# --- columns ----------------------------------------------------------------------------------


@query("rename_listings", with_(RAW) + RAW_SELECT + ", source FROM raw")
def rename_listings(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.rename_listings(v.raw_listings(spark, sf))


CLEAN_VALUES = f"""clean_values AS (SELECT "Préfecture" AS prefecture, "Zone" AS zone_admin,
    lower({strip('"Quartier"')}) AS zone, {clean_price('"Valeur vénale (FCFA)"')} AS prix,
    {to_number('"Surface (m²)"')} AS surface_m2,
    {clean_price('"Valeur/m² (FCFA)"')} AS prix_m2_officiel, 'ValeursVenales' AS source
    FROM raw_values WHERE "Valeur/m² (FCFA)" IS NOT NULL)"""


@query("clean_official", with_(RAW_VALUES, CLEAN_VALUES) + "SELECT * FROM clean_values")
def clean_official(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_official(v.raw_official(spark, sf))


@query(
    "clean_price",
    with_(RAW)
    + f"""SELECT "Prix" AS texte, {clean_price('"Prix"')} AS prix FROM raw
    UNION ALL SELECT props, {clean_price('props')} FROM events
    UNION ALL SELECT NULL, abs(c_acctbal) FROM customer""",
)
def clean_price_query(spark: SparkSession, sf: str) -> DataFrame:
    listed = v.raw_listings(spark, sf).select(F.col("Prix").alias("texte"))
    props = v.table(spark, sf, "events").select(F.col("props").alias("texte"))
    written = listed.unionByName(props)
    stated = v.table(spark, sf, "customer").select(
        F.lit(None).cast("string").alias("texte"),
        numbers.clean_price(F.col("c_acctbal"), numeric=True).alias("prix"),
    )
    return written.withColumn("prix", numbers.clean_price(F.col("texte"))).unionByName(stated)


@query(
    "coerce_numeric",
    with_(RAW)
    + f"""SELECT "Surface" AS surface, {to_number('"Surface"')} AS surface_m2, "Prix" AS prix,
    {to_number('"Prix"')} AS prix_nombre, {to_number('"Piece"')} AS pieces FROM raw""",
)
def coerce_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return v.raw_listings(spark, sf).select(
        F.col("Surface").alias("surface"),
        numbers.to_number(F.col("Surface")).alias("surface_m2"),
        F.col("Prix").alias("prix"),
        numbers.to_number(F.col("Prix")).alias("prix_nombre"),
        numbers.to_number(F.col("Piece")).alias("pieces"),
    )


@query(
    "normalize_zone",
    with_(RAW)
    + f"""SELECT "Quartier" AS brut, lower({strip('"Quartier"')}) AS zone, count(*) AS nb
    FROM raw GROUP BY ALL
    UNION ALL SELECT text, lower({strip('text')}), 1 FROM documents""",
)
def normalize_zone(spark: SparkSession, sf: str) -> DataFrame:
    raw = v.raw_listings(spark, sf).groupBy(F.col("Quartier").alias("brut")).agg(
        F.count(F.lit(1)).alias("nb")
    )
    texts = v.table(spark, sf, "documents").select(
        F.col("text").alias("brut"), F.lit(1).cast("bigint").alias("nb")
    )
    both = raw.unionByName(texts)
    return both.withColumn("zone", text.normalize_text(F.col("brut")))


def standard_types(spark: SparkSession, sf: str) -> DataFrame:
    raw = v.raw_listings(spark, sf)
    return profiles.count_by(raw.select(F.col("Type de bien").alias("brut")), ["brut"], "nb")


@query(
    "standardize_type",
    with_(RAW)
    + f"""SELECT brut, coalesce({looked_up("cle", fixed.PROPERTY_TYPES)}, {initcap("cle")})
    AS type_bien, coalesce({looked_up("cle", fixed.PROPERTY_TYPES)}, {initcap("cle")},
    'Non specifie') AS type_ou_defaut, nb FROM (SELECT "Type de bien" AS brut,
    {TYPE_KEY} AS cle, count(*) AS nb FROM raw GROUP BY ALL)""",
)
def standardize_type(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.col("brut")
    return standard_types(spark, sf).withColumns(
        {
            "type_bien": text.standardize_type(raw),
            "type_ou_defaut": text.standardize_type(raw, fixed.UNSPECIFIED_TYPE),
        }
    )


RAW_TYPE_TRIMMED = strip('"Type de bien"')


@query(
    "standardize_type_load",
    with_(RAW)
    + f"""SELECT brut, coalesce({looked_up("lower(net)", fixed.PROPERTY_TYPES_AT_LOAD)},
    {title("net")}) AS type_bien, nb FROM (SELECT "Type de bien" AS brut,
    {RAW_TYPE_TRIMMED} AS net, count(*) AS nb FROM raw GROUP BY ALL)""",
)
def standardize_type_load(spark: SparkSession, sf: str) -> DataFrame:
    label = text.standardize_type_at_load(F.col("brut"))
    return standard_types(spark, sf).withColumn("type_bien", label)


RAW_OFFER = '''"Type d'offre"'''


@query(
    "standardize_offer",
    with_(RAW)
    + f"""SELECT {RAW_OFFER} AS brut, upper({strip(RAW_OFFER)}) AS type_offre, count(*) AS nb
    FROM raw GROUP BY ALL""",
)
def standardize_offer(spark: SparkSession, sf: str) -> DataFrame:
    raw = v.raw_listings(spark, sf).select(F.col("Type d'offre").alias("brut"))
    offers = profiles.count_by(raw, ["brut"], "nb")
    return offers.withColumn("type_offre", text.standardize_offer(F.col("brut")))


# Spellings of source names made from the priorities of the orders.
SOURCE_TEXT = """CASE o_orderpriority WHEN '1-URGENT' THEN ' ImmoAsk' WHEN '2-HIGH' THEN 'FACEBOOK'
    WHEN '3-MEDIUM' THEN 'coinafrique ' WHEN '4-NOT SPECIFIED' THEN NULL
    ELSE lower(o_orderpriority) END"""


@query(
    "standardize_source",
    f"""SELECT brut, coalesce({looked_up(f"lower({strip('brut')})", fixed.SOURCE_NAMES)},
    {title(strip("brut"))}) AS source, nb FROM (SELECT {SOURCE_TEXT} AS brut, count(*) AS nb
    FROM orders GROUP BY ALL)""",
)
def standardize_source(spark: SparkSession, sf: str) -> DataFrame:
    raw = v.table(spark, sf, "orders").select(F.expr(SOURCE_TEXT).alias("brut"))
    names = profiles.count_by(raw, ["brut"], "nb")
    return names.withColumn("source", text.standardize_source(F.col("brut")))


@query(
    "extract_rooms",
    with_(RAW)
    + f"""SELECT "Type de bien" AS type_bien, {ROOMS_IN_TYPE}::DOUBLE AS pieces, count(*) AS nb
    FROM raw GROUP BY ALL""",
)
def extract_rooms(spark: SparkSession, sf: str) -> DataFrame:
    raw = v.raw_listings(spark, sf).select(F.col("Type de bien").alias("type_bien"))
    types = profiles.count_by(raw, ["type_bien"], "nb")
    return real_rooms(types.withColumn("pieces", numbers.rooms_from_type(F.col("type_bien"))))


@query(
    "fill_rooms",
    with_(RAW)
    + f"""SELECT "Piece" AS brut, "Type de bien" AS type_bien, coalesce({STATED_ROOMS},
    CASE WHEN {ROOMS_IN_TYPE} > 0 THEN {ROOMS_IN_TYPE} END)::DOUBLE AS pieces, count(*) AS nb
    FROM raw GROUP BY ALL""",
)
def fill_rooms(spark: SparkSession, sf: str) -> DataFrame:
    raw = v.raw_listings(spark, sf).select(
        F.col("Piece").alias("brut"), F.col("Type de bien").alias("type_bien")
    )
    pairs = profiles.count_by(raw, ["brut", "type_bien"], "nb")
    filled = numbers.fill_rooms(F.col("brut"), F.col("type_bien"))
    return real_rooms(pairs.withColumn("pieces", filled))


@query(
    "parse_rooms",
    with_(RAW)
    + f"""SELECT "Piece" AS brut, ({ROOMS})::DOUBLE AS pieces, "Piece" IS NOT NULL AND "Piece" = '1.2.3'
    AS refuse, count(*) AS nb FROM raw GROUP BY ALL""",
)
def parse_rooms_query(spark: SparkSession, sf: str) -> DataFrame:
    raw = v.raw_listings(spark, sf).select(F.col("Piece").alias("brut"))
    counts = profiles.count_by(raw, ["brut"], "nb")
    parsed, refused = numbers.parse_rooms(F.col("brut")), numbers.malformed_rooms(F.col("brut"))
    return real_rooms(counts.withColumns({"pieces": parsed, "refuse": refused}))


@query("standardize_listings", with_(RAW, STANDARD) + f"SELECT {CANONICAL} FROM standard")
def standardize_listings(spark: SparkSession, sf: str) -> DataFrame:
    return real_rooms(cleaning.standardize_listings(v.raw_listings(spark, sf)))


RATIO = exact_round("prix / nullif(surface_m2, 0)", 2)


@query(
    "price_per_m2",
    with_(RAW, STANDARD)
    + f"""SELECT prix, surface_m2, CASE WHEN prix <> 0 AND surface_m2 > 0 THEN {RATIO} END
    AS prix_m2 FROM standard""",
)
def price_per_m2(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.standardize_listings(v.raw_listings(spark, sf)).select("prix", "surface_m2")
    return df.withColumn("prix_m2", numbers.price_per_m2(F.col("prix"), F.col("surface_m2")))


# --- quality rules ----------------------------------------------------------------------------


@query(
    "filter_positive",
    with_(RAW, STANDARD) + f"SELECT {CANONICAL} FROM standard WHERE prix > 0 AND surface_m2 > 0",
)
def filter_positive(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.standardize_listings(v.raw_listings(spark, sf))
    return real_rooms(quality.keep_positive(df))


@query(
    "filter_known_zone",
    with_(RAW, STANDARD)
    + f"""SELECT {CANONICAL} FROM standard
    WHERE zone NOT IN ('non spécifié', 'non spécifiés', '')""",
)
def filter_known_zone(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.standardize_listings(v.raw_listings(spark, sf))
    return real_rooms(quality.keep_known_zone(df))


DESCRIPTIVE = QualityParams(
    price_m2_max=20_000, zone_max_length=9, suspicious_words=("hot", "old")
)


@query(
    "reject_cascade",
    with_(RAW, STANDARD, LISTINGS)
    + f"""SELECT zone, prix, surface_m2, {reason("zone", "prix", "surface_m2")} AS raison_rejet
    FROM standard UNION ALL SELECT titre, prix, surface_m2,
    {reason("titre", "prix", "surface_m2", DESCRIPTIVE)} FROM listings""",
)
def reject_cascade(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["zone", "prix", "surface_m2"]
    raw = cleaning.standardize_listings(v.raw_listings(spark, sf)).select(*columns)
    described = v.listings(spark, sf, "titre", "prix", "surface_m2").toDF(*columns)
    return quality.tag_reasons(raw, PARAMS).unionByName(
        quality.tag_reasons(described, DESCRIPTIVE)
    )


@query("valid_rows", with_(RAW, STANDARD, TAGGED) + f"SELECT {CANONICAL} FROM tagged WHERE raison_rejet IS NULL")
def valid_rows(spark: SparkSession, sf: str) -> DataFrame:
    return real_rooms(quality.split(stored(spark, sf))[0])


@query(
    "reject_rows",
    with_(RAW, STANDARD, TAGGED)
    + f"SELECT {CANONICAL}, raison_rejet FROM tagged WHERE raison_rejet IS NOT NULL",
)
def reject_rows(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "rejects")
    rows = quality.split(stored(spark, sf))[1]
    writers.write_rejects(rows, path)
    return real_rooms(spark.read.schema(rows.schema).parquet(path))


@query(
    "clean_v1",
    with_(RAW)
    + f""", first AS (SELECT "Titre" AS titre, "Type d'offre" AS type_offre,
    "Type de bien" AS type_bien, lower({strip('"Quartier"')}) AS zone,
    {clean_price('"Prix"')} AS prix, "Piece" AS pieces, {to_number('"Surface"')} AS surface_m2, source
    FROM raw), placed AS (SELECT *, row_number() OVER (PARTITION BY source, titre, prix, zone ORDER BY
    {ORDER}, surface_m2) AS place FROM first WHERE prix > 0 AND surface_m2 > 0
    AND zone NOT IN ('non spécifié', 'non spécifiés', ''))
    SELECT titre, type_offre, type_bien, zone, prix, pieces, surface_m2, source FROM placed
    WHERE place = 1""",
)
def clean_v1(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_listings_v1(v.raw_listings(spark, sf))


# Coarse prices and surfaces, so that many listings are copies of one another.
COARSE = """coarse AS (SELECT titre, zone, source, type_bien, type_offre,
    floor(prix / 20000) * 20000 AS prix, ceil(surface_m2 / 25) * 25 AS surface_m2 FROM listings)"""


def coarse(spark: SparkSession, sf: str) -> DataFrame:
    df = v.listings(
        spark, sf, "titre", "zone", "source", "type_bien", "type_offre", "prix", "surface_m2"
    )
    return df.withColumns(
        {
            "prix": F.floor(F.col("prix") / 20000).cast("double") * 20000,
            "surface_m2": F.ceil(F.col("surface_m2") / 25).cast("double") * 25,
        }
    )


COARSE_COLUMNS = "titre, zone, source, type_bien, type_offre, prix, surface_m2"


@query(
    "dedup_3key",
    with_(LISTINGS, COARSE)
    + f"""SELECT {COARSE_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY source, titre,
    prix, zone ORDER BY type_bien, type_offre, surface_m2) AS place FROM coarse)
    WHERE place = 1""",
)
def dedup_3key(spark: SparkSession, sf: str) -> DataFrame:
    return quality.drop_duplicates_v1(coarse(spark, sf))


@query(
    "dedup_4key",
    with_(LISTINGS, COARSE)
    + f"""SELECT {COARSE_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY source, titre,
    prix, zone, surface_m2 ORDER BY type_bien, type_offre) AS place FROM coarse)
    WHERE place = 1""",
)
def dedup_4key(spark: SparkSession, sf: str) -> DataFrame:
    return quality.drop_duplicates(coarse(spark, sf))


@query(
    "reject_report",
    with_(RAW, STANDARD, TAGGED)
    + """SELECT source, raison_rejet, count(*) AS nb_lignes FROM tagged
    WHERE raison_rejet IS NOT NULL GROUP BY ALL""",
)
def reject_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.reject_report(stored(spark, sf))


@query(
    "quality_summary",
    CLEAN
    + f""", counted AS (SELECT source, 1 AS v, 0 AS r FROM valid UNION ALL
    SELECT source, 0, 1 FROM tagged WHERE raison_rejet IS NOT NULL),
    sums AS (SELECT source AS perimetre, sum(v) AS v, sum(r) AS r FROM counted GROUP BY source
    UNION ALL SELECT 'TOTAL', sum(v), sum(r) FROM counted)
    SELECT perimetre, CAST(v + r AS BIGINT) AS avant, CAST(v AS BIGINT) AS valides,
    CAST(r AS BIGINT) AS rejetes, {percent("r", "v + r", 2)} AS taux_rejet FROM sums""",
)
def quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_summary(tagged(spark, sf))


PROFILE_COLUMNS = ("zone", "prix", "pieces", "surface_m2", "type_bien", "titre")
MISSING = " UNION ALL ".join(
    f"SELECT source, '{c}' AS colonne, count(*) - count({c}) AS manquants, count(*) AS total "
    f"FROM standard GROUP BY source"
    for c in PROFILE_COLUMNS
)


@query(
    "missing_profile",
    with_(RAW, STANDARD, f"missing AS ({MISSING})")
    + f"""SELECT source, colonne, manquants, {percent("manquants", "total", 1)} AS pourcentage
    FROM missing WHERE manquants > 0""",
)
def missing_profile(spark: SparkSession, sf: str) -> DataFrame:
    df = cleaning.standardize_listings(v.raw_listings(spark, sf))
    return quality.missing_profile(df.select("source", *PROFILE_COLUMNS), "source")


WORDS = " OR ".join(f"contains(lower(zone), '{w}')" for w in fixed.PROFILE_WORDS)
RAW_ZONES = 'zones AS (SELECT source, "Quartier" AS zone FROM raw)'


def raw_zones(spark: SparkSession, sf: str) -> DataFrame:
    return v.raw_listings(spark, sf).select("source", F.col("Quartier").alias("zone"))


@query(
    "suspicious_zones",
    with_(RAW, RAW_ZONES) + f"SELECT DISTINCT source, zone FROM zones WHERE {WORDS}",
)
def suspicious_zones(spark: SparkSession, sf: str) -> DataFrame:
    return quality.suspicious_zones(raw_zones(spark, sf))


@query(
    "long_zones",
    with_(RAW, RAW_ZONES) + "SELECT DISTINCT source, zone FROM zones WHERE length(zone) > 30",
)
def long_zones(spark: SparkSession, sf: str) -> DataFrame:
    return quality.long_zones(raw_zones(spark, sf))


@query(
    "eda_price_profile",
    with_(LISTINGS)
    + f""", per_m2 AS (SELECT source, prix / surface_m2 AS p FROM listings),
    flagged AS (SELECT *, p > 1000 AND p < 20000 AS inside FROM per_m2)
    SELECT source, count(*) AS nb_total, count(*) FILTER (inside) AS nb_valides,
    count(*) FILTER (NOT inside) AS nb_rejetes,
    {percent("count(*) FILTER (inside)", "count(*)", 1)} AS part_valides,
    round(sum(CAST(p AS DECIMAL(24,8))) FILTER (inside)::DOUBLE / count(*) FILTER (inside), 4)
    AS prix_m2_moyen, round((quantile_disc(p, 0.5) FILTER (inside) - quantile_disc(-p, 0.5) FILTER (inside)) / 2, 4) AS prix_m2_median,
    min(p) FILTER (inside) AS prix_m2_min, max(p) FILTER (inside) AS prix_m2_max
    FROM flagged GROUP BY source""",
)
def eda_price_profile(spark: SparkSession, sf: str) -> DataFrame:
    df = v.listings(spark, sf, "source", "prix", "surface_m2")
    df = df.select("source", F.try_divide("prix", "surface_m2").alias("prix_m2"))
    out = profiles.price_profile(df, high=20_000)
    return out.withColumns(
        {c: F.round(c, 4) for c in ("prix_m2_moyen", "prix_m2_median")}
    )
