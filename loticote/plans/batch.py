"""The whole batch: raw files, clean listings, star schema, statistics, index, dashboard tables.

Every step reads what the step before has written, so a step that is repeated after a failure
starts from stored tables, and nothing is computed once per output.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from loticote.functions import fixed_values as fixed
from loticote.operators import cleaning, dashboard, index, profiles, quality, star, statistics
from loticote.operators.quality import REASON, QualityParams
from loticote.session import clear_scratch, materialize, tune_listings
from loticote.sources import readers, writers
from loticote.sources.schemas import LISTING, RAW_LISTING
from loticote.sources.versions import Refresh, committed, prune, read_buckets, write_buckets

INDEX_KEYS = ("id_zone", "type_bien", "type_offre")
STATS_KEYS = ("zone", *INDEX_KEYS)
BUCKET_KEYS = ("id_zone", star.SLICE)


def ingest_sources(
    spark: SparkSession, files: dict[str, str], fmt: str, landing: str, **options: str
) -> None:
    """Bring the file of every source, in any format of Spark, into the landing folder, tagged with its name."""
    for source, path in files.items():
        writers.write_landing(readers.ingest(spark, path, fmt, source, **options), f"{landing}/{source}")


def land_files(
    spark: SparkSession,
    raw: str,
    landing: str,
    sources: Sequence[str] = fixed.LISTING_SOURCES,
    multiline: bool = True,
) -> None:
    """Parse the CSV files of all sources and the official values once, into the landing folder.

    A file with quoted line breaks is parsed by one task; what is landed is text in Parquet, in files of
    even size that split, so that no later step depends on how the files came.
    """
    for source in sources:
        rows = readers.read_if_present(spark, f"{raw}/{source}.csv", source, RAW_LISTING, multiline)
        writers.write_landing(rows, f"{landing}/{source}")
    official = readers.read_official(spark, f"{raw}/valeursvenales.csv", multiline)
    writers.write_landing(official, f"{landing}/valeursvenales")


def clean(
    spark: SparkSession,
    raw: str,
    out: str,
    sources: Sequence[str] = fixed.LISTING_SOURCES,
    params: QualityParams = QualityParams(),
    multiline: bool = True,
    landed: bool = False,
) -> DataFrame:
    """Write tagged, valid, rejected and official rows; returns the quality report.

    ``raw`` holds CSV files, which are landed first, or with ``landed`` what ``ingest_sources`` and
    ``land_files`` have landed. The tagged rows are stored once, in one folder per reason. Valid rows
    and rejects are then read from their own folders instead of running the rules for every output.
    """
    landing = raw if landed else f"{out}/depot"
    if not landed:
        land_files(spark, raw, landing, sources, multiline)
    frames = [readers.read_landed(spark, f"{landing}/{s}", s, RAW_LISTING) for s in sources]
    tagged = readers.union_sources([cleaning.tag_listings(f, params) for f in frames])
    # Rows of a reason meet in a few tasks first, so that a folder gets a few files and not one per task.
    writers.write_rejects(tagged.hint("rebalance", REASON), f"{out}/etiquetees")
    stored = spark.read.schema(tagged.schema).parquet(f"{out}/etiquetees")

    valid, rejected = quality.split(stored)
    kept = quality.drop_duplicates(valid).hint("rebalance", "source")
    writers.write_parquet(kept, f"{out}/annonces_parquet", ["source"])
    writers.write_csv(read_valid(spark, out), f"{out}/annonces")
    writers.write_csv(rejected, f"{out}/annonces_rejetees")

    official = cleaning.clean_official(spark.read.parquet(f"{landing}/valeursvenales"))
    writers.write_parquet(official, f"{out}/venales_parquet")
    writers.write_csv(official, f"{out}/venales")
    return quality.stored_summary(read_valid(spark, out), rejected)


def read_valid(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(LISTING).parquet(f"{out}/annonces_parquet")


def read_loaded(spark: SparkSession, out: str, zone: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(loaded listings, skipped ones with their reason) as the load has stored them."""
    path = committed(spark, f"{out}/etoile")["chargement"]
    loaded, skipped = star.split_load(spark.read.parquet(path))
    return star.in_zone(loaded, zone), skipped


def model(spark: SparkSession, out: str) -> DataFrame:
    """Build the star schema from the clean tables; returns the rows written per table.

    Listings and official values that cannot be loaded are stored with their reason and counted
    as ``annonces_ignorees`` and ``valeurs_ignorees``: loaded and skipped rows are all rows given. All
    counts are taken while the tables are written. The new star is taken into use as a whole when its last
    table is written; results that were computed from an earlier star are removed with it.
    """
    listings = read_valid(spark, out)
    official = spark.read.parquet(f"{out}/venales_parquet")
    rejected = spark.read.parquet(f"{out}/etiquetees").where(F.col(REASON).isNotNull())

    with Refresh(spark, f"{out}/etoile") as new:
        counts = writers.write_star(new, {"source_donnees": star.dim_source(listings)})
        new.write("zones_annonces", star.dim_zone(listings))
        listed = spark.read.parquet(new.path("zones_annonces"))
        counts |= writers.write_star(new, {"zone_geographique": star.upsert_zones(listed, official)})
        sources = writers.read_folder(spark, new.path("source_donnees"), "source_donnees")
        zones = writers.read_folder(spark, new.path("zone_geographique"), "zone_geographique")
        star.require_distinct_keys(sources, "source_donnees")
        star.require_distinct_keys(zones, "zone_geographique")

        tagged = star.cluster_by_zone(star.tag_load(listings, zones, sources))
        ignored = {"ignored": F.count_if(F.col(star.SKIP_REASON).isNotNull())}
        load = new.write("chargement", tagged, [star.SKIP_REASON], ignored)
        loaded = star.split_load(spark.read.schema(tagged.schema).parquet(new.path("chargement")))[0]
        facts = {
            "annonce": star.fact_listing(loaded),
            "bien_immobilier": star.dim_property(loaded),
            "valeur_venale": star.fact_official(official, zones, listed),
            "annonces_rejetees": star.rejects_table(rejected),
        }
        counts |= writers.write_star(new, facts)
        counts |= writers.clear_results(new)
        refused = new.write("valeurs_ignorees", star.split_official(official)[1])
        counts |= {"annonces_ignorees": load["ignored"], "valeurs_ignorees": refused["rows"]}
    return writers.count_table(spark, counts)


def read_views(spark: SparkSession, out: str, zone: str | None = None) -> dict[str, DataFrame]:
    """The views the analysis works on, from the stored star; listings of one zone if it is given."""
    root = f"{out}/etoile"
    loaded = read_loaded(spark, out)[0]
    chosen = star.in_zone(loaded, zone)
    zones = writers.read_star_table(spark, root, "zone_geographique")
    sources = writers.read_star_table(spark, root, "source_donnees")
    official = writers.read_star_table(spark, root, "valeur_venale")
    return {
        "zones": star.zone_view(chosen, zones),
        "listings": star.listing_view(chosen, zones, sources),
        "official": star.official_view(official, zones),
        "sources": star.listings_per_source(sources, loaded),
    }


def store_buckets(spark: SparkSession, out: str, buckets: int, slices: int = 1) -> None:
    """Store listings and zones once more, in the same buckets of zone and slice, for repeated joins.

    Worth it when the zones are too many to be broadcast and the join is made often: the listings are
    shuffled here and not in each join. A zone is spread over ``slices`` buckets, and the zones are stored
    as many times.
    """
    with Refresh(spark, f"{out}/etoile") as new:
        zones = writers.read_folder(spark, new.path("zone_geographique"), "zone_geographique")
        loaded = star.sliced_listings(star.split_load(spark.read.parquet(new.path("chargement")))[0], slices)
        named = star.sliced_zones(zones, slices).withColumnRenamed("id", "id_zone").select("id_zone", "nom", star.SLICE)
        for name, df in (("annonces_par_zone", loaded), ("noms_par_zone", named)):
            write_buckets(df, new.place(name, f"-{buckets}"), BUCKET_KEYS, buckets)


def bucketed_zone_view(spark: SparkSession, out: str) -> DataFrame:
    """The zone view from the buckets: listings and zones meet bucket by bucket, without a shuffle."""
    tables = committed(spark, f"{out}/etoile")

    def read(name: str) -> DataFrame:
        path = tables[name]
        return read_buckets(spark, path, spark.read.parquet(path).schema, BUCKET_KEYS, int(path.rsplit("-", 1)[1]))

    return star.zone_view(read("annonces_par_zone"), read("noms_par_zone"))


def measure(
    spark: SparkSession,
    out: str,
    per_official_row: bool = False,
    index_keys: Sequence[str] = INDEX_KEYS,
) -> DataFrame:
    """Store statistics with their gap to official values and the index built on them, in one commit.

    One row per statistic and one per index value. ``per_official_row`` stores a statistic once
    for every official row of its zone, and ``index_keys`` without the offer compares every offer
    of a zone and type with every other; both multiply rows. Rows with a number that no column can hold
    are stored as ``resultats_refuses``. Returns the rows written per table.
    """
    views = read_views(spark, out)
    stats = statistics.zone_stats(views["zones"], STATS_KEYS)
    official = views["official"].select("zone", "prix_m2_officiel")
    gaps = statistics.official_gap(stats, official, aggregate=not per_official_row)
    gaps = materialize(gaps, "gaps")
    # The index is that of the statistics that are stored.
    stored = writers.split_results(gaps, "statistiques_zone")[0]
    prices = index.storable_index(index.price_index(stored, index_keys))
    results = {"statistiques_zone": gaps, "indice_immobilier": prices}
    return writers.count_table(spark, writers.write_results(spark, results, f"{out}/etoile"))


def read_statistics(spark: SparkSession, out: str) -> DataFrame:
    """Stored statistics with the names of their zones, numbers as the dashboard computes them."""
    root = f"{out}/etoile"
    zones = writers.read_star_table(spark, root, "zone_geographique")
    stats = star.stats_view(writers.read_star_table(spark, root, "statistiques_zone"), zones)
    decimals = [f.name for f in stats.schema.fields if isinstance(f.dataType, DecimalType)]
    return stats.withColumns({c: F.col(c).cast("double") for c in decimals}).withColumnRenamed("zone_nom", "zone")


def dashboard_tables(
    spark: SparkSession,
    out: str,
    zone: str | None = None,
    types: Sequence[str] = (),
    offer: str | None = None,
) -> dict[str, DataFrame]:
    """Every table of the dashboard under the chosen filters."""
    views = read_views(spark, out, zone)
    stats = dashboard.apply_filters(read_statistics(spark, out), zone, types, offer)
    listings = dashboard.apply_filters(views["listings"], zone, types, offer)
    by_zone = statistics.index_by_type_zone(views["zones"])
    by_zone = dashboard.apply_filters(by_zone, zone, types, offer, zone_column="zone_nom")
    return {
        "kpis": dashboard.kpis(stats),
        "sources": views["sources"],
        "top_zones": dashboard.top_zones(stats),
        "histogram": profiles.histogram(listings, "prix_m2", 50, "type_offre", trim=0.95),
        "market_vs_official": dashboard.market_vs_official(listings, views["official"]),
        "map": dashboard.map_points(stats),
        "dearest": dashboard.extreme_listings(listings, 10, highest=True),
        "cheapest": dashboard.extreme_listings(listings, 10, highest=False, floor=100),
        "type_index": index.type_index(by_zone),
        "zone_table": dashboard.zone_table(stats),
    }


def export_filtered(
    spark: SparkSession,
    out: str,
    to: str,
    zone: str | None = None,
    types: Sequence[str] = (),
    offer: str | None = None,
) -> None:
    """Write the chosen statistics and listings as CSV folders."""
    listings = read_views(spark, out, zone)["listings"]
    frames = {"statistiques": read_statistics(spark, out), "annonces": listings}
    for name, df in frames.items():
        writers.write_csv(dashboard.apply_filters(df, zone, types, offer), f"{to}/{name}")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw", help="folder with one CSV file (or folder) per source")
    parser.add_argument("out", help="folder for clean tables, star schema and results")
    parser.add_argument("--single-line", action="store_true", help="no line breaks inside quotes")
    args = parser.parse_args()
    spark = tune_listings(SparkSession.builder.appName("loticote").getOrCreate())
    clean(spark, args.raw, args.out, multiline=not args.single_line).show(truncate=False)
    model(spark, args.out).show(truncate=False)
    measure(spark, args.out).show(truncate=False)
    prune(spark, f"{args.out}/etoile")
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
