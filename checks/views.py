"""Listing and official-value views over the given tables, for Spark and for the SQL oracle.

The raw views spell columns the way scraped listings do: blanks and tabs around text, prices with
a currency, room counts as text, unusable zones and surfaces. Which row gets which spelling
follows from columns of the tables; no row is left out. Their column expressions are plain SQL
that both engines read, so both sides see the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loticote.functions.numbers import price_per_m2
from loticote.operators.quality import QualityParams

# Prices per square metre of the tables run from 19 to 105 000, so the upper bound is lowered.
PARAMS = QualityParams(price_m2_max=20_000)

LISTING_COLUMNS = (
    "titre", "type_offre", "type_bien", "zone", "prix", "surface_m2", "source", "prix_m2",
)

RAW_TYPE = """CASE p_size
    WHEN 1 THEN 'chambre' WHEN 2 THEN ' Villas ' WHEN 3 THEN '2 Chambres' WHEN 4 THEN '3chambre'
    WHEN 5 THEN '4 chambres a coucher' WHEN 6 THEN 'Studio meublé' WHEN 7 THEN 'bureau/commerce'
    WHEN 8 THEN 'l''ecole/bar' WHEN 9 THEN 'STATION' WHEN 10 THEN 'terrains agricoles'
    WHEN 11 THEN 'Entrepôt' WHEN 12 THEN 'chambre salon' WHEN 13 THEN '1chambre salon'
    WHEN 14 THEN 'chambres' WHEN 15 THEN 'Appart' WHEN 16 THEN 'immeuble de rapport'
    WHEN 17 THEN 'Loft duplex' WHEN 18 THEN '12 chambres' WHEN 19 THEN '0 chambre'
    WHEN 20 THEN NULL WHEN 21 THEN 'TERRAIN' WHEN 22 THEN 'Villa Meublée' WHEN 23 THEN 'hotel'
    WHEN 24 THEN 'boutiques' WHEN 25 THEN 'local commercial' ELSE lower(p_type) END"""

RAW_ZONE = """CASE p_size
    WHEN 7 THEN NULL WHEN 11 THEN 'Non spécifié' WHEN 13 THEN concat('Face a la poste ', n_name)
    WHEN 17 THEN concat(n_name, ' pres du grand marche, rue ', p_name)
    WHEN 19 THEN concat(n_name, ' non loin') WHEN 23 THEN 'TOGO' WHEN 29 THEN 'Bè'
    WHEN 31 THEN 'BE ' WHEN 37 THEN 'Baguida' ELSE concat(' ', n_name, chr(9)) END"""

WHOLE_PRICE = "cast(floor(l_extendedprice) as bigint)"
RAW_PRICE = f"""CASE
    WHEN p_size = 37 THEN 'N/A'
    WHEN p_size = 38 THEN '1.500.000'
    WHEN l_linenumber = 1 THEN concat(cast({WHOLE_PRICE} as string), ' FCFA')
    WHEN l_linenumber = 2 THEN concat(cast(cast(floor(l_extendedprice / 1000) as bigint) as string),
        ' ', lpad(cast({WHOLE_PRICE} % 1000 as string), 3, '0'))
    WHEN l_linenumber IN (4, 5) THEN
        cast(cast(floor(l_extendedprice / 10000) as bigint) * 10000 as string)
    ELSE cast(cast(l_extendedprice as decimal(15, 2)) as string) END"""

RAW_SURFACE = """CASE
    WHEN p_size = 41 THEN '' WHEN p_size = 43 THEN 'grand' WHEN p_size = 47 THEN '0'
    WHEN l_linenumber IN (4, 5) THEN cast(cast(ceil(l_quantity / 25) as bigint) * 25 as string)
    ELSE cast(cast(l_quantity as bigint) as string) END"""

RAW_ROOMS = """CASE
    WHEN p_size = 30 THEN '1.2.3' WHEN p_size = 31 THEN '-2' WHEN p_size = 32 THEN '3.7'
    WHEN p_size = 33 THEN ' 3 ' WHEN p_size = 4 THEN '-2'
    WHEN p_size < 10 THEN NULL WHEN p_size < 20 THEN 'Non spécifié'
    WHEN p_size < 40 THEN concat(cast(p_size as string), '.0') ELSE cast(p_size as string) END"""

RAW_LISTING = {
    "Source0": "o_orderpriority",
    "Titre": "p_name",
    "Type d'offre": "CASE l_linestatus WHEN 'F' THEN ' Vente' ELSE concat('location', chr(9)) END",
    "Type de bien": RAW_TYPE,
    "Quartier": RAW_ZONE,
    "Prix": RAW_PRICE,
    "Piece": RAW_ROOMS,
    "Surface": RAW_SURFACE,
    "source": "o_orderpriority",
}

OFFICIAL_ZONE = "CASE WHEN s_acctbal > 9000 THEN concat(n_name, ' nord') ELSE n_name END"
RAW_OFFICIAL = {
    "Préfecture": "concat('PREFECTURE ', cast(n_regionkey as string))",
    "Zone": "concat('ZONE ', cast(n_nationkey as string))",
    "Type d'offre": "'VENTE'",
    "Type de bien": "'TERRAIN'",
    "Quartier": f"concat(' ', {OFFICIAL_ZONE})",
    "Valeur vénale (FCFA)":
        "concat(cast(cast(floor(abs(s_acctbal) * 600) as bigint) as string), ' F')",
    "Surface (m²)": "'600'",
    "Valeur/m² (FCFA)":
        "CASE WHEN s_acctbal > 0 THEN cast(cast(s_acctbal as decimal(15, 2)) as string) END",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _with_part(spark: SparkSession, sf: str, df: DataFrame) -> DataFrame:
    part = table(spark, sf, "part")
    return df.join(part, df.l_partkey == part.p_partkey, "left")


def _with_zone(spark: SparkSession, sf: str, df: DataFrame) -> DataFrame:
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return df.join(supplier, df.l_suppkey == supplier.s_suppkey, "left").join(
        nation, supplier.s_nationkey == nation.n_nationkey, "left"
    )


def _with_source(spark: SparkSession, sf: str, df: DataFrame) -> DataFrame:
    orders = table(spark, sf, "orders")
    return df.join(orders, df.l_orderkey == orders.o_orderkey, "left")


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    # The table is one file with one row group, which one task would read and compute on. Orders are joined
    # first, while the rows lie by this key; a join by another key would shuffle the rows once more.
    return table(spark, sf, "lineitem").repartition("l_orderkey")


def listings(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Listing view with the wanted columns; a table no wanted column needs is not joined."""
    wanted = columns or LISTING_COLUMNS
    df = _facts(spark, sf)
    if "source" in wanted:
        df = _with_source(spark, sf, df)
    if {"titre", "type_bien"} & set(wanted):
        df = _with_part(spark, sf, df)
    if "zone" in wanted:
        df = _with_zone(spark, sf, df)
    offer = F.when(F.col("l_linestatus") == "F", "VENTE").otherwise("LOCATION")
    known = {
        "titre": lambda: F.col("p_name"),
        "type_offre": lambda: offer,
        "type_bien": lambda: F.col("p_type"),
        "zone": lambda: F.lower("n_name"),
        "prix": lambda: F.col("l_extendedprice"),
        "surface_m2": lambda: F.col("l_quantity"),
        "source": lambda: F.col("o_orderpriority"),
        "prix_m2": lambda: price_per_m2(F.col("l_extendedprice"), F.col("l_quantity")),
        "annee": lambda: F.date_format("l_shipdate", "yyyy"),
    }
    return df.select(*[known[c]().alias(c) for c in wanted])


def raw_listings(spark: SparkSession, sf: str, *further: str) -> DataFrame:
    df = _with_source(spark, sf, _facts(spark, sf))
    df = _with_zone(spark, sf, _with_part(spark, sf, df))
    return df.select(*[F.expr(text).alias(name) for name, text in RAW_LISTING.items()], *further)


def raw_official(spark: SparkSession, sf: str) -> DataFrame:
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    df = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    return df.select(*[F.expr(text).alias(name) for name, text in RAW_OFFICIAL.items()])


def official(spark: SparkSession, sf: str) -> DataFrame:
    """Official prices with the zone as listings spell it; several rows per zone, some unpriced."""
    supplier, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    df = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    return df.select(
        F.lower(F.expr(OFFICIAL_ZONE)).alias("zone"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("prix_m2_officiel"),
    )


# --- the same views in SQL --------------------------------------------------------------------


def exact_round(x: str, digits: int) -> str:
    """SQL form of the rounding of the exact binary value, ties to even."""
    scale, split = f"{10**digits}::DOUBLE", "134217729::DOUBLE"
    product = f"(({x}) * {scale})"
    high = f"(({x}) * {split} - (({x}) * {split} - ({x})))"
    error = f"(({high} * {scale} - {product}) + (({x}) - {high}) * {scale})"
    low = f"floor({product})"
    rest = f"({product} - {low})"
    up = (
        f"{rest} > 0.5 OR ({rest} = 0.5 AND ({error} > 0 OR "
        f"({error} = 0 AND {low} % 2 <> 0)))"
    )
    return f"(({low} + CASE WHEN {up} THEN 1 ELSE 0 END) / {scale})"


def scaled_round(x: str, digits: int) -> str:
    return f"(round_even(({x}) * {10**digits}::DOUBLE, 0) / {10**digits}::DOUBLE)"


def mean(x: str, scale: int = 2) -> str:
    return f"(sum(CAST({x} AS DECIMAL({scale + 16},{scale})))::DOUBLE / count({x}))"


def median(x: str) -> str:
    """Mean of the two middle values."""
    return f"((quantile_disc({x}, 0.5) - quantile_disc(-({x}), 0.5)) / 2)"


def percent(part: str, whole: str, digits: int) -> str:
    return exact_round(f"({part})::DOUBLE / ({whole}) * 100", digits)


def strip(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(13))"


FROM_LINEITEM = """FROM lineitem
    LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN orders ON l_orderkey = o_orderkey"""


def _columns(expressions: dict[str, str]) -> str:
    return ",\n    ".join(f'{text} AS "{name}"' for name, text in expressions.items())


def per_m2(price: str, surface: str) -> str:
    rounded = exact_round(f"{price} / {surface}", 2)
    return f"CASE WHEN {price} <> 0 AND {surface} > 0 THEN {rounded} END"


LISTINGS = f"""listings AS (SELECT p_name AS titre,
    CASE WHEN l_linestatus = 'F' THEN 'VENTE' ELSE 'LOCATION' END AS type_offre,
    p_type AS type_bien, lower(n_name) AS zone, l_extendedprice AS prix,
    l_quantity AS surface_m2, o_orderpriority AS source, strftime(l_shipdate, '%Y') AS annee,
    {per_m2("l_extendedprice", "l_quantity")} AS prix_m2
    {FROM_LINEITEM})"""

RAW = f"raw AS (SELECT {_columns(RAW_LISTING)}, l_linenumber\n    {FROM_LINEITEM})"

FROM_SUPPLIER = "FROM supplier JOIN nation ON s_nationkey = n_nationkey"
RAW_VALUES = f"raw_values AS (SELECT {_columns(RAW_OFFICIAL)}\n    {FROM_SUPPLIER})"
OFFICIAL = f"""official AS (SELECT lower({OFFICIAL_ZONE}) AS zone,
    CASE WHEN s_acctbal > 0 THEN s_acctbal END AS prix_m2_officiel {FROM_SUPPLIER})"""

STATS = f"""stats AS (SELECT zone, type_bien, type_offre, {scaled_round(mean("prix_m2"), 2)} AS
    prix_moyen_m2, {scaled_round(median("prix_m2"), 2)} AS prix_median_m2,
    min(prix) AS prix_min, max(prix) AS prix_max, count(*) AS nombre_annonces,
    'GLOBAL' AS periode FROM listings WHERE prix_m2 > 0 GROUP BY ALL)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
