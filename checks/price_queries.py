"""Statistics, gap to official values, price index, dashboard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from checks.registry import query
from checks.views import LISTINGS, OFFICIAL, STATS, mean, median, scaled_round, with_
from loticote.functions import fixed_values as fixed
from loticote.functions.labels import trend
from loticote.operators import dashboard, index, profiles, statistics, summary
from loticote.session import materialize

OFFICIAL_MEAN = f"""official_mean AS (SELECT zone, {mean("prix_m2_officiel")} AS prix_m2_officiel
    FROM official GROUP BY zone)"""
GAP = scaled_round("(prix_moyen_m2 - prix_m2_officiel) / prix_m2_officiel * 100", 2)


def stats(spark: SparkSession, sf: str) -> DataFrame:
    view = v.listings(spark, sf, "zone", "type_bien", "type_offre", "prix", "prix_m2")
    return statistics.zone_stats(view)


def stored_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics as the batch stores them, for what is built on top of them."""
    return materialize(stats(spark, sf), "stats")


def label(value: str, labels: tuple[str, str, str]) -> str:
    above, below, between = labels
    return f"CASE WHEN {value} > 105 THEN '{above}' WHEN {value} < 95 THEN '{below}' ELSE '{between}' END"


def index_sql(source: str, keys: tuple[str, ...], reference: str) -> str:
    same = " AND ".join(f"s.{k} = r.{k}" for k in keys)
    value = scaled_round("s.prix_moyen_m2 / r.prix_moyen_m2 * 100", 4)
    return f"""priced AS (SELECT s.*, r.prix_moyen_m2 AS prix_reference, {value} AS indice_valeur
    FROM {source} s LEFT JOIN (SELECT * FROM {source} WHERE periode = {reference}) r ON {same}),
    indexed AS (SELECT *, {label("indice_valeur", fixed.TREND_LABELS)} AS tendance FROM priced)"""


# --- statistics -------------------------------------------------------------------------------


@query("zone_stats", with_(LISTINGS, STATS) + "SELECT * FROM stats")
def zone_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats(spark, sf)


@query(
    "official_gap",
    with_(LISTINGS, OFFICIAL, STATS)
    + f"""SELECT stats.*, prix_m2_officiel, {GAP} AS ecart_valeur_venale
    FROM stats LEFT JOIN official USING (zone)""",
)
def official_gap(spark: SparkSession, sf: str) -> DataFrame:
    return statistics.official_gap(stored_stats(spark, sf), v.official(spark, sf))


@query(
    "official_gap_avg",
    with_(LISTINGS, OFFICIAL, STATS, OFFICIAL_MEAN)
    + f"""SELECT stats.*, prix_m2_officiel, {GAP} AS ecart_valeur_venale
    FROM stats LEFT JOIN official_mean USING (zone)""",
)
def official_gap_avg(spark: SparkSession, sf: str) -> DataFrame:
    return statistics.official_gap(stored_stats(spark, sf), v.official(spark, sf), aggregate=True)


def extreme_zones_sql(order: str) -> str:
    return (
        with_(LISTINGS, STATS)
        + f"""SELECT zone, type_bien, type_offre, prix_moyen_m2, nombre_annonces FROM stats
        ORDER BY prix_moyen_m2 {order}, zone, type_bien, type_offre LIMIT 5"""
    )


@query("top5_zones", extreme_zones_sql("DESC"))
def top5_zones(spark: SparkSession, sf: str) -> DataFrame:
    return statistics.extreme_zones(stats(spark, sf), 5, highest=True)


@query("bottom5_zones", extreme_zones_sql("ASC"))
def bottom5_zones(spark: SparkSession, sf: str) -> DataFrame:
    return statistics.extreme_zones(stats(spark, sf), 5, highest=False)


# --- index ------------------------------------------------------------------------------------

INDEXED = with_(LISTINGS, STATS, index_sql("stats", index.ZONE_TYPE, "'GLOBAL'"))


@query("price_index", INDEXED + "SELECT * FROM indexed WHERE indice_valeur IS NOT NULL")
def price_index(spark: SparkSession, sf: str) -> DataFrame:
    return index.storable_index(index.price_index(stored_stats(spark, sf)))


@query(
    "price_index_by_offer",
    with_(LISTINGS, STATS, index_sql("stats", index.ZONE_TYPE_OFFER, "'GLOBAL'"))
    + "SELECT * FROM indexed",
)
def price_index_by_offer(spark: SparkSession, sf: str) -> DataFrame:
    return index.price_index(stored_stats(spark, sf), index.ZONE_TYPE_OFFER)


PERIOD_STATS = STATS.replace("stats AS", "periods AS").replace(
    "'GLOBAL' AS periode", "annee AS periode"
)


def period_index(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["zone", "type_bien", "type_offre", "prix", "prix_m2", "annee"]
    yearly = statistics.zone_stats(v.listings(spark, sf, *columns), period="annee")
    return index.price_index(materialize(yearly, "yearly"), index.ZONE_TYPE_OFFER, reference=None)


OLDEST = "(SELECT min(periode) FROM periods)"
PERIODS = with_(LISTINGS, PERIOD_STATS, index_sql("periods", index.ZONE_TYPE_OFFER, OLDEST))


@query("price_index_periods", PERIODS + "SELECT * FROM indexed")
def price_index_periods(spark: SparkSession, sf: str) -> DataFrame:
    return period_index(spark, sf)


@query(
    "trend_label",
    with_(LISTINGS)
    + f"""SELECT surface_m2, prix_m2, {label("prix_m2 / 20", fixed.TREND_LABELS)} AS tendance
    FROM listings""",
)
def trend_label(spark: SparkSession, sf: str) -> DataFrame:
    df = v.listings(spark, sf, "surface_m2", "prix_m2")
    return df.withColumn("tendance", trend(F.col("prix_m2") / 20))


@query(
    "trend_counts",
    PERIODS + "SELECT tendance, count(*) AS nb_lignes FROM indexed GROUP BY tendance",
)
def trend_counts(spark: SparkSession, sf: str) -> DataFrame:
    return index.trend_counts(period_index(spark, sf))


@query(
    "trend_examples",
    PERIODS
    + """SELECT zone, type_bien, indice_valeur FROM indexed WHERE tendance = 'HAUSSE'
    ORDER BY ALL LIMIT 5""",
)
def trend_examples(spark: SparkSession, sf: str) -> DataFrame:
    return index.trend_examples(period_index(spark, sf), "HAUSSE")


AVERAGE = "CAST(sum(CAST(prix_m2 AS DECIMAL(18,2))) * 100 AS HUGEINT)"
BY_ZONE = f"""by_zone AS (SELECT type_bien, type_offre, zone AS zone_nom,
    ((2 * {AVERAGE} * 10000 + count(*)) // (2 * count(*)))::DOUBLE / 1000000 AS prix_moyen_m2,
    count(*) AS nb_annonces FROM listings WHERE prix_m2 > 0 GROUP BY ALL HAVING count(*) >= 2)"""


def by_type_zone(spark: SparkSession, sf: str) -> DataFrame:
    view = v.listings(spark, sf, "zone", "type_bien", "type_offre", "prix_m2")
    return statistics.index_by_type_zone(view)


@query("index_by_type_zone", with_(LISTINGS, BY_ZONE) + "SELECT * FROM by_zone")
def index_by_type_zone(spark: SparkSession, sf: str) -> DataFrame:
    return by_type_zone(spark, sf)


TYPE_BASE = f"(SELECT {mean('prix_moyen_m2', 6)} FROM by_zone)"


@query(
    "type_index",
    with_(
        LISTINGS,
        BY_ZONE,
        f"""types AS (SELECT type_bien, type_offre, {mean("prix_moyen_m2", 6)} AS prix_moyen_m2,
        CAST(sum(nb_annonces) AS BIGINT) AS nb_annonces FROM by_zone GROUP BY ALL)""",
        f"""indexed AS (SELECT *, {scaled_round(f"prix_moyen_m2 / {TYPE_BASE} * 100", 2)}
        AS indice FROM types)""",
    )
    + f"SELECT *, {label('indice', fixed.POSITION_LABELS)} AS tendance FROM indexed",
)
def type_index(spark: SparkSession, sf: str) -> DataFrame:
    return index.type_index(by_type_zone(spark, sf))


# --- dashboard --------------------------------------------------------------------------------

CHOSEN = "zone = 'nation_3' AND type_bien IN ('PROMO', 'SMALL') AND type_offre = 'VENTE'"


@query(
    "dashboard_filter",
    with_(LISTINGS, STATS)
    + f"""SELECT 'statistiques' AS cadre, zone, type_bien, type_offre, prix_moyen_m2 AS prix_m2
    FROM stats WHERE {CHOSEN} UNION ALL SELECT 'annonces', zone, type_bien, type_offre, prix_m2
    FROM listings WHERE {CHOSEN}
    UNION ALL SELECT 'zones', zone, type_bien, type_offre, prix_moyen_m2 FROM stats""",
)
def dashboard_filter(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["zone", "type_bien", "type_offre", "prix_m2"]
    measured = stored_stats(spark, sf).withColumnRenamed("prix_moyen_m2", "prix_m2").select(*columns)
    frames = {
        "statistiques": dashboard.apply_filters(measured, "nation_3", ["PROMO", "SMALL"], "VENTE"),
        "annonces": dashboard.apply_filters(
            v.listings(spark, sf, *columns), "nation_3", ["PROMO", "SMALL"], "VENTE"
        ),
        "zones": dashboard.apply_filters(measured),
    }
    tagged = [df.select(F.lit(name).alias("cadre"), *columns) for name, df in frames.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query(
    "kpi_summary",
    with_(LISTINGS, STATS)
    + f"""SELECT {mean("prix_moyen_m2")} AS prix_moyen_m2,
    CAST(sum(nombre_annonces) AS BIGINT) AS annonces_analysees,
    count(DISTINCT zone) AS zones_couvertes,
    {scaled_round(median("prix_median_m2"), 4)} AS prix_median_m2,
    (SELECT count(*) FROM listings WHERE prix_m2 > 0) AS biens_uniques FROM stats""",
)
def kpi_summary(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.kpis(stored_stats(spark, sf)).withColumn(
        "prix_median_m2", F.rint(F.col("prix_median_m2") * 10000) / 10000
    )


ZONE_MEAN = f"""zone_means AS (SELECT zone, {mean("prix_moyen_m2")} AS prix_moyen_m2
    FROM stats GROUP BY zone)"""


@query("zone_mean", with_(LISTINGS, STATS, ZONE_MEAN) + "SELECT * FROM zone_means")
def zone_mean(spark: SparkSession, sf: str) -> DataFrame:
    return statistics.zone_mean(stored_stats(spark, sf))


@query(
    "top20_zones",
    with_(LISTINGS, STATS, ZONE_MEAN)
    + "SELECT * FROM zone_means ORDER BY prix_moyen_m2 DESC, zone LIMIT 20",
)
def top20_zones(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.top_zones(stored_stats(spark, sf))


LIMIT = "(SELECT quantile_cont(prix_m2, 0.95) FROM listings)"


@query(
    "p95_price",
    with_(LISTINGS)
    + f"SELECT {scaled_round('quantile_cont(prix_m2, 0.95)', 4)} AS p95 FROM listings",
)
def p95_price(spark: SparkSession, sf: str) -> DataFrame:
    df = summary.quantile(v.listings(spark, sf, "prix_m2"), "prix_m2", 0.95, "p95")
    return df.select((F.rint(F.col("p95") * 10000) / 10000).alias("p95"))


@query(
    "trim_p95",
    with_(LISTINGS)
    + f"SELECT titre, zone, prix_m2 FROM listings WHERE prix_m2 <= {LIMIT}",
)
def trim_p95(spark: SparkSession, sf: str) -> DataFrame:
    return summary.trim_quantile(v.listings(spark, sf, "titre", "zone", "prix_m2"), "prix_m2", 0.95)


def bins_sql(rows: str, by: str, low: str, high: str, bins: int) -> str:
    """Bins by their edges: the bin whose lower edge is the last one not above the value."""
    return f"""edges AS (SELECT r.{by}, r.prix_m2, {low} AS low, ({high} - {low}) / {bins} AS width
    FROM {rows} r),
    guessed AS (SELECT *, least(floor((prix_m2 - low) / width), {bins - 1}) AS guess FROM edges),
    binned AS (SELECT *, CAST(guess - CASE WHEN prix_m2 < low + guess * width THEN 1 ELSE 0 END
    + CASE WHEN prix_m2 >= low + (guess + 1) * width AND guess < {bins - 1} THEN 1 ELSE 0 END
    AS INTEGER) AS classe FROM guessed)"""


TRIMMED = f"trimmed AS (SELECT type_offre, prix_m2 FROM listings WHERE prix_m2 <= {LIMIT})"
GLOBAL_BINS = bins_sql(
    "trimmed",
    "type_offre",
    "(SELECT min(prix_m2) FROM trimmed)",
    "(SELECT max(prix_m2) FROM trimmed)",
    50,
)


@query(
    "price_histogram",
    with_(LISTINGS, TRIMMED, GLOBAL_BINS)
    + """SELECT type_offre, classe, round(low + classe * width, 6) AS borne_inf,
    count(*) AS nb_annonces FROM binned GROUP BY ALL""",
)
def price_histogram(spark: SparkSession, sf: str) -> DataFrame:
    rows = v.listings(spark, sf, "type_offre", "prix_m2")
    counts = profiles.histogram(rows, "prix_m2", 50, "type_offre", trim=0.95)
    return counts.withColumn("borne_inf", F.round("borne_inf", 6))


BAND = "band AS (SELECT source, prix_m2 FROM listings WHERE prix_m2 > 1000 AND prix_m2 < 20000)"
SOURCE_BINS = bins_sql(
    "band",
    "source",
    "(SELECT min(prix_m2) FROM band b WHERE b.source = r.source)",
    "(SELECT max(prix_m2) FROM band b WHERE b.source = r.source)",
    40,
)


@query(
    "price_histogram_by_source",
    with_(LISTINGS, BAND, SOURCE_BINS)
    + f""", lines AS (SELECT source, {mean("prix_m2")} AS moyenne,
    {scaled_round(median("prix_m2"), 4)} AS mediane FROM band GROUP BY source)
    SELECT source, classe, round(low + classe * width, 6) AS borne_inf, moyenne, mediane,
    count(*) AS nb_annonces FROM binned JOIN lines USING (source) GROUP BY ALL""",
)
def price_histogram_by_source(spark: SparkSession, sf: str) -> DataFrame:
    rows = v.listings(spark, sf, "source", "prix_m2")
    rows = rows.where(profiles.in_band(F.col("prix_m2"), high=20_000))
    counts = profiles.histogram_by_group(rows, "prix_m2", 40, "source")
    return counts.withColumns(
        {
            "borne_inf": F.round("borne_inf", 6),
            "mediane": F.rint(F.col("mediane") * 10000) / 10000,
        }
    )


@query(
    "market_vs_official",
    with_(LISTINGS, OFFICIAL, OFFICIAL_MEAN.replace("GROUP BY", "WHERE prix_m2_officiel IS NOT NULL GROUP BY"))
    + f"""SELECT zone, {mean("prix_m2")} AS prix_marche_m2,
    any_value(prix_m2_officiel) AS prix_venale_m2
    FROM listings JOIN official_mean USING (zone) GROUP BY zone
    ORDER BY prix_marche_m2 DESC, zone LIMIT 15""",
)
def market_vs_official(spark: SparkSession, sf: str) -> DataFrame:
    listed = v.listings(spark, sf, "zone", "prix_m2")
    return dashboard.market_vs_official(listed, v.official(spark, sf))


# The zones of the tables get the names of the mapped ones, in the order of the nation keys.
COORDS = ", ".join(f"('{z}', {lat}, {lon})" for z, lat, lon in fixed.ZONE_COORDINATES)
COORDS = f"coords AS (SELECT z, lat::DOUBLE AS lat, lon::DOUBLE AS lon FROM (VALUES {COORDS}) AS t(z, lat, lon))"
MAPPED = """CASE zone WHEN 'nation_0' THEN ' Baguida ' WHEN 'nation_1' THEN 'AGOE'
    WHEN 'nation_2' THEN 'be' WHEN 'nation_3' THEN 'bè' WHEN 'nation_4' THEN 'lome'
    WHEN 'nation_5' THEN 'tokoin' WHEN 'nation_6' THEN 'kegue' ELSE zone END"""
POINTS = f"""named AS (SELECT {MAPPED} AS zone, prix_moyen_m2 FROM stats),
points AS (SELECT zone, {mean("prix_moyen_m2")} AS prix_moyen_m2, any_value(lat) AS lat,
    any_value(lon) AS lon FROM named JOIN coords ON lower(trim(zone)) = z GROUP BY zone)"""


def named_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stored_stats(spark, sf).withColumn("zone", F.expr(MAPPED))


@query("zone_map", with_(LISTINGS, STATS, COORDS, POINTS) + "SELECT * FROM points")
def zone_map(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.zone_map(named_stats(spark, sf))


LOW, HIGH = "(SELECT min(prix_moyen_m2) FROM points)", "(SELECT max(prix_moyen_m2) FROM points)"
RATIO = f"((prix_moyen_m2 - {LOW}) / ({HIGH} - {LOW} + 1))"


def byte(x: str) -> str:
    return f"lpad(lower(to_hex(CAST(trunc({x}) AS BIGINT))), 2, '0')"


WHOLE_MEAN = "format('{:,}', CAST(round_even(prix_moyen_m2, 0) AS BIGINT))"


@query(
    "map_color_scale",
    with_(LISTINGS, STATS, COORDS, POINTS)
    + f"""SELECT *, '#' || {byte(f"{RATIO} * 255")} || {byte(f"(1 - {RATIO}) * 255")} || '33'
    AS couleur, upper(left(trim(zone), 1)) || lower(substr(trim(zone), 2)) || ' - '
    || {WHOLE_MEAN} || ' FCFA/m2' AS legende FROM points""",
)
def map_color_scale(spark: SparkSession, sf: str) -> DataFrame:
    trimmed = F.regexp_replace("legende", "^ *([^ ]+) * - ", "$1 - ")
    return dashboard.map_points(named_stats(spark, sf)).withColumn("legende", trimmed)


LISTED = ("titre", "zone", "type_bien", "prix_m2", "source")
TIES = "titre, zone, type_bien, prix_m2, source"


@query(
    "top10_listings",
    with_(LISTINGS)
    + f"SELECT {TIES} FROM listings ORDER BY prix_m2 DESC, {TIES} LIMIT 10",
)
def top10_listings(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.extreme_listings(v.listings(spark, sf, *LISTED), 10, highest=True)


@query(
    "bottom10_listings",
    with_(LISTINGS)
    + f"SELECT {TIES} FROM listings WHERE prix_m2 > 100 ORDER BY prix_m2, {TIES} LIMIT 10",
)
def bottom10_listings(spark: SparkSession, sf: str) -> DataFrame:
    listed = v.listings(spark, sf, *LISTED)
    return dashboard.extreme_listings(listed, 10, highest=False, floor=100)


@query(
    "zone_table",
    with_(LISTINGS, OFFICIAL, STATS)
    + f"""SELECT zone, type_bien, type_offre, prix_moyen_m2, prix_median_m2, nombre_annonces,
    {GAP} AS ecart_valeur_venale FROM stats LEFT JOIN official USING (zone)""",
)
def zone_table(spark: SparkSession, sf: str) -> DataFrame:
    gaps = statistics.official_gap(stored_stats(spark, sf), v.official(spark, sf))
    return dashboard.zone_table(gaps)


def grouped_digits(x: str) -> str:
    return f"format('{{:,}}', CAST(round_even({x}, 0) AS BIGINT)) || ' FCFA'"


@query(
    "format_prices",
    with_(LISTINGS)
    + f"""SELECT titre, {grouped_digits("prix")} AS prix, {grouped_digits("prix_m2")} AS prix_m2
    FROM listings""",
)
def format_prices(spark: SparkSession, sf: str) -> DataFrame:
    df = v.listings(spark, sf, "titre", "prix", "prix_m2")
    return dashboard.format_prices(df, ["prix", "prix_m2"], " FCFA")
