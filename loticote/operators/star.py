"""Star schema: dimensions, loaded listings, official values, views over the star."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loticote.functions import fixed_values as fixed
from loticote.functions.numbers import malformed_rooms, parse_rooms, price_per_m2
from loticote.functions.text import (
    fold_text,
    normalize_text,
    standardize_source,
    standardize_type_at_load,
    upper_trim,
)

SKIP_REASON = "raison_ignore"


def dim_key(name: Column) -> Column:
    """Key of a dimension row. A hash needs no numbering pass and is the same on every run."""
    return F.xxhash64(name)


def key_clashes(dim: DataFrame) -> DataFrame:
    """Keys that stand for more than one name, with these names."""
    names = dim.groupBy("id").agg(F.count_distinct("nom").alias("_names"), F.min("nom").alias("a"), F.max("nom").alias("b"))
    return names.where(F.col("_names") > 1).select("id", "a", "b")


def require_distinct_keys(dim: DataFrame, name: str) -> None:
    """Stop before two names that share a key would be taken for one."""
    clash = key_clashes(dim).orderBy("id").first()
    if clash:
        raise ValueError(f"{name}: {clash.a!r} and {clash.b!r} have the same key {clash.id}")


def listing_key(*identity: Column) -> Column:
    """128-bit key of a listing. The flags keep a NULL apart from an empty or shifted value."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in identity]
    flags = [F.when(c.isNull(), "0").otherwise("1") for c in identity]
    return F.md5(F.concat_ws("\x1f", *flags, *parts))


def dim_source(listings: DataFrame) -> DataFrame:
    """Distinct standard source names; the official source is always among them."""
    # Names are standardised once per distinct raw spelling, not once per listing.
    raw = listings.select("source").where(F.col("source").isNotNull()).distinct()
    names = raw.select(standardize_source(F.col("source")).alias("nom"))
    always = listings.sparkSession.range(1).select(F.lit(fixed.OFFICIAL_SOURCE).alias("nom"))
    return names.unionByName(always).distinct().select(
        dim_key(normalize_text(F.col("nom"))).alias("id"),
        "nom",
        F.lit("").alias("url"),
        F.lit(fixed.COLLECTION_DATE).cast("date").alias("date_collecte"),
        F.lit(0).alias("nombre_annonces"),
    )


def _zone_rows(names: DataFrame, prefecture: Column) -> DataFrame:
    return names.select(
        dim_key(F.col("nom")).alias("id"),
        "nom",
        F.lit(fixed.COMMUNE).alias("commune"),
        prefecture.alias("prefecture"),
        F.lit(None).cast("string").alias("zone_admin"),
    )


def dim_zone(listings: DataFrame) -> DataFrame:
    """Distinct zones of the listings, without the spellings that name no zone."""
    names = listings.select("zone").where(F.col("zone").isNotNull()).distinct()
    names = names.select(normalize_text(F.col("zone")).alias("nom")).distinct()
    return _zone_rows(names.where(~F.col("nom").isin(*fixed.NOT_A_ZONE)), F.lit(fixed.PREFECTURE))


def upsert_zones(zones: DataFrame, official: DataFrame) -> DataFrame:
    """Add the official zones the dimension lacks, with the prefecture stated for them."""
    stated = official.select(normalize_text(F.col("zone")).alias("nom"), "prefecture")
    fresh = (
        stated.where(F.col("nom").isNotNull())
        .groupBy("nom")
        .agg(F.min("prefecture").alias("_prefecture"))
        .join(zones.select("nom"), "nom", "left_anti")
    )
    prefecture = F.coalesce(F.col("_prefecture"), F.lit(fixed.PREFECTURE))
    return zones.unionByName(_zone_rows(fresh, prefecture))


def with_keys(df: DataFrame, zones: DataFrame, sources: DataFrame) -> DataFrame:
    """Look up both dimension keys by name; NULL where the name is unknown.

    Dimensions read from a stored table are broadcast when their real size allows, otherwise the
    join shuffles and adaptive execution splits a hot zone.
    """
    zone_keys = zones.select(F.col("id").alias("id_zone"), F.col("nom").alias("_zone"))
    source_keys = sources.select(
        F.col("id").alias("id_source"), normalize_text(F.col("nom")).alias("_source")
    )
    return (
        df.withColumn("_zone", normalize_text(F.col("zone")))
        .withColumn("_source", normalize_text(F.col("source")))
        .join(zone_keys, "_zone", "left")
        .join(source_keys, "_source", "left")
        .drop("_zone", "_source")
    )


def _fits(value: Column, kind: str) -> Column:
    return value.isNull() | value.try_cast(kind).isNotNull()


def _refusal() -> Column:
    """What in the row itself keeps it from being loaded."""
    fits = _fits(F.col("surface_m2"), "decimal(10,2)") & _fits(F.col("prix"), "decimal(15,2)")
    per_m2 = price_per_m2(F.col("prix"), F.col("surface_m2"))
    fits = fits & _fits(per_m2, "decimal(10,2)")
    return F.when(malformed_rooms(F.col("pieces")), "pieces_invalides").when(
        ~fits, "valeur_hors_bornes"
    )


def _skip_reason(refusal: Column) -> Column:
    return (
        F.when(F.col("id_zone").isNull(), "zone_inconnue")
        .when(F.col("id_source").isNull(), "source_inconnue")
        .otherwise(refusal)
    )


def cut_text(name: str, width: int | None) -> Column:
    """The text as wide as its table column; ``None`` leaves it whole."""
    return (F.col(name) if width is None else F.substring(name, 1, width)).alias(name)


def tag_load(
    listings: DataFrame,
    zones: DataFrame,
    sources: DataFrame,
    title_width: int | None = fixed.TITLE_WIDTH,
) -> DataFrame:
    """All listings with keys, load-time columns and the reason why one cannot be loaded, or NULL.

    A listing and its property are one to one, so both live in one row here: the join between two
    tables of the size of the facts never happens. ``fact_listing`` and ``dim_property`` project
    the two tables from it. Input rows must be free of copies (see ``quality.drop_duplicates``),
    which makes the key unique.
    """
    keyed = with_keys(listings, zones, sources)
    identity = [F.col(c) for c in ("source", "titre", "prix", "zone", "surface_m2")]
    return keyed.select(
        listing_key(*identity).alias("id"),
        cut_text("titre", title_width),
        "prix",
        "surface_m2",
        price_per_m2(F.col("prix"), F.col("surface_m2")).alias("prix_m2"),
        parse_rooms(F.col("pieces")).alias("pieces"),
        F.coalesce(
            standardize_type_at_load(F.col("type_bien")), F.lit(fixed.UNKNOWN_AT_LOAD)
        ).alias("type_bien"),
        F.coalesce(upper_trim(F.col("type_offre")), F.upper(F.lit(fixed.UNKNOWN_AT_LOAD))).alias(
            "type_offre"
        ),
        "id_zone",
        "id_source",
        "zone",
        "source",
        _skip_reason(_refusal()).alias(SKIP_REASON),
    )


def cluster_by_zone(tagged: DataFrame) -> DataFrame:
    """Rows in ranges of zones, so that files and row groups without a wanted zone are skipped.

    The listing's key follows the zone in the ranges: a zone with very many listings gets several files.
    """
    return tagged.repartitionByRange(SKIP_REASON, "id_zone", "id").sortWithinPartitions(SKIP_REASON, "id_zone")


def in_zone(loaded: DataFrame, zone: str | None) -> DataFrame:
    """Listings of one zone, found by its key: the filter needs no join and reaches the files."""
    return loaded if zone is None else loaded.where(F.col("id_zone") == dim_key(F.lit(zone)))


def split_load(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loaded listings, skipped ones with their reason); together all that was given."""
    loaded = tagged.where(F.col(SKIP_REASON).isNull()).drop("zone", "source", SKIP_REASON)
    skipped = tagged.where(F.col(SKIP_REASON).isNotNull())
    return loaded, skipped.drop("id", "id_zone", "id_source", "prix_m2")


def load_listings(listings: DataFrame, zones: DataFrame, sources: DataFrame) -> DataFrame:
    """Listings that can be loaded; see ``tag_load`` for those that cannot."""
    return split_load(tag_load(listings, zones, sources))[0]


def fact_listing(loaded: DataFrame) -> DataFrame:
    return loaded.select(
        "id", "titre", "prix", "prix_m2", F.col("id").alias("id_bien"), "id_source"
    )


def dim_property(loaded: DataFrame) -> DataFrame:
    return loaded.select("id", "type_bien", "type_offre", "surface_m2", "pieces", "id_zone")


def pair_listings(listing: DataFrame, prop: DataFrame) -> DataFrame:
    """Join listings and properties that are stored as two tables back into one row each."""
    return listing.join(prop.withColumnRenamed("id", "id_bien"), "id_bien").drop("id_bien")


def load_skipped(listings: DataFrame, zones: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows loaded and rows skipped by reason. Rows are counted before the lookups."""
    counted = (
        listings.select("zone", "source", _refusal().alias("_refusal"))
        .groupBy("zone", "source", "_refusal")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    reason = F.coalesce(_skip_reason(F.col("_refusal")), F.lit("chargee")).alias(SKIP_REASON)
    keyed = with_keys(counted, zones, sources)
    return keyed.groupBy(reason).agg(F.sum("_rows").alias("nb_lignes"))


def _official_refusal() -> Column:
    fits = _fits(F.col("prix_m2_officiel"), "decimal(10,2)") & _fits(F.col("surface_m2"), "decimal(10,2)")
    fits = fits & _fits(F.col("prix"), "decimal(15,2)")
    return F.when(F.col("zone").isNull(), "zone_inconnue").when(~fits, "valeur_hors_bornes")


def split_official(official: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(official values that can be stored, refused ones with the reason)."""
    tagged = official.withColumn(SKIP_REASON, _official_refusal())
    stored = tagged.where(F.col(SKIP_REASON).isNull()).drop(SKIP_REASON)
    return stored, tagged.where(F.col(SKIP_REASON).isNotNull())


def fact_official(official: DataFrame, zones: DataFrame, listed: DataFrame) -> DataFrame:
    """Official values with their zone key; values that the table cannot hold are left out.

    ``listed`` is the dimension before the official zones were added. A zone it has under the
    same name is taken as is; one that differs from a listed zone only in accents resolves to
    that zone, as the accent-insensitive lookup of the stored names does.
    """
    named = split_official(official)[0].withColumn("nom", normalize_text(F.col("zone")))
    exact = listed.select("nom", F.lit(True).alias("_listed"))
    folded = listed.groupBy(fold_text(F.col("nom")).alias("_folded")).agg(
        F.min_by("id", "nom").alias("_near")
    )
    return (
        named.join(zones.select("nom", F.col("id").alias("_own")), "nom")
        .join(exact, "nom", "left")
        .withColumn("_folded", fold_text(F.col("nom")))
        .join(folded, "_folded", "left")
        .select(
            F.when(F.col("_listed"), F.col("_own"))
            .otherwise(F.coalesce(F.col("_near"), F.col("_own")))
            .alias("id_zone"),
            "prix_m2_officiel",
            "surface_m2",
            F.col("prix").alias("valeur_totale"),
        )
    )


def rejects_table(
    rejected: DataFrame, widths: Mapping[str, int | None] = fixed.REJECT_WIDTHS
) -> DataFrame:
    """Rejected rows with the text widths of the table; missing text stays NULL."""
    order = ["titre", "zone", "prix", "surface_m2", "type_bien", "type_offre", "source"]
    return rejected.select(*[cut_text(c, widths.get(c)) for c in [*order, "raison_rejet"]])


SLICE = "tranche"


def sliced_listings(loaded: DataFrame, slices: int) -> DataFrame:
    """Listings with a number that spreads the listings of one zone over some slices."""
    return loaded.withColumn(SLICE, F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int"))


def sliced_zones(zones: DataFrame, slices: int) -> DataFrame:
    """Every zone once for each slice, so that a zone's listings find it wherever they are."""
    numbers = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    return zones.select("*", numbers.alias(SLICE))


def _priced(df: DataFrame) -> DataFrame:
    return df.where(F.col("prix_m2") > 0)


def zone_view(loaded: DataFrame, zones: DataFrame) -> DataFrame:
    """Priced listings with property columns and zone name; sliced tables meet slice by slice."""
    keys = [c for c in ("id_zone", SLICE) if c == "id_zone" or c in loaded.columns]
    names = zones.withColumnsRenamed({"id": "id_zone", "nom": "zone"}).select("zone", *keys)
    return _priced(loaded).join(names, keys).drop(SLICE)


def listing_view(loaded: DataFrame, zones: DataFrame, sources: DataFrame) -> DataFrame:
    """Priced listings with property columns, zone name and source name."""
    names = sources.select(F.col("id").alias("id_source"), F.col("nom").alias("source"))
    return (
        zone_view(loaded, zones)
        .join(names, "id_source")
        .select(
            "prix", "prix_m2", "titre", "type_bien", "type_offre", "surface_m2", "zone", "source"
        )
    )


def stats_view(stats: DataFrame, zones: DataFrame) -> DataFrame:
    names = zones.select(F.col("id").alias("id_zone"), F.col("nom").alias("zone_nom"))
    return stats.join(names, "id_zone")


def official_view(official: DataFrame, zones: DataFrame) -> DataFrame:
    names = zones.select(F.col("id").alias("id_zone"), F.col("nom").alias("zone"))
    priced = official.where(F.col("prix_m2_officiel").isNotNull())
    return priced.join(names, "id_zone").select(
        "prix_m2_officiel", "surface_m2", "valeur_totale", "zone"
    )


def listings_per_source(sources: DataFrame, loaded: DataFrame) -> DataFrame:
    """Listings of every source, also of those without any. Counted before the join."""
    counts = loaded.groupBy("id_source").agg(F.count("id").alias("_rows"))
    return (
        sources.select(F.col("id").alias("id_source"), F.col("nom").alias("source"))
        .join(counts, "id_source", "left")
        .select("source", F.coalesce(F.col("_rows"), F.lit(0)).alias("nombre_annonces"))
        .orderBy(F.desc("nombre_annonces"), "source")
    )
