"""Column lists and table schemas."""

from pyspark.sql import types as T

from loticote.functions import fixed_values as fixed


def schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TEXT, WHOLE, KEY, REAL, DAY = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(),
)
RATE, INDEX, AMOUNT = T.DecimalType(10, 2), T.DecimalType(10, 4), T.DecimalType(15, 2)

# Raw listing as scraped, under its own header; every column is text.
RAW_LISTING = schema(**{name: TEXT for name in [*fixed.LISTING_COLUMNS, "source"]})

LISTING = schema(
    titre=TEXT, type_offre=TEXT, type_bien=TEXT, zone=TEXT, prix=REAL, pieces=WHOLE,
    surface_m2=REAL, source=TEXT,
)
OFFICIAL = schema(
    prefecture=TEXT, zone_admin=TEXT, zone=TEXT, prix=REAL, surface_m2=REAL,
    prix_m2_officiel=REAL, source=TEXT,
)

# Star schema. Keys of the two dimensions are 64-bit hashes of the name; a listing and its
# property share the 128-bit hash of the listing's identity, because 64 bits would collide at
# the number of listings this is meant for.
STAR = {
    "source_donnees": schema(
        id=KEY, nom=TEXT, url=TEXT, date_collecte=DAY, nombre_annonces=WHOLE
    ),
    "zone_geographique": schema(
        id=KEY, nom=TEXT, commune=TEXT, prefecture=TEXT, zone_admin=TEXT
    ),
    "bien_immobilier": schema(
        id=TEXT, type_bien=TEXT, type_offre=TEXT, surface_m2=RATE, pieces=WHOLE, usage=TEXT,
        id_zone=KEY,
    ),
    "annonce": schema(
        id=TEXT, titre=TEXT, prix=AMOUNT, prix_m2=RATE, date_annonce=DAY, id_bien=TEXT,
        id_source=KEY,
    ),
    "statistiques_zone": schema(
        id_zone=KEY, type_bien=TEXT, type_offre=TEXT, periode=TEXT, prix_moyen_m2=RATE,
        prix_median_m2=RATE, prix_min=AMOUNT, prix_max=AMOUNT, nombre_annonces=WHOLE,
        ecart_valeur_venale=RATE,
    ),
    "indice_immobilier": schema(
        id_zone=KEY, type_bien=TEXT, type_offre=TEXT, periode=TEXT, prix_moyen_m2=RATE,
        indice_valeur=INDEX, tendance=TEXT,
    ),
    "valeur_venale": schema(
        id_zone=KEY, prix_m2_officiel=RATE, surface_m2=RATE, valeur_totale=AMOUNT
    ),
    "annonces_rejetees": schema(
        titre=TEXT, zone=TEXT, prix=REAL, surface_m2=REAL, type_bien=TEXT, type_offre=TEXT,
        source=TEXT, raison_rejet=TEXT,
    ),
}

# Result tables have one folder per period; a refresh of the star leaves them empty.
RESULT_TABLES = ("statistiques_zone", "indice_immobilier")
