"""Fixed values. Results are only right when these equal the agreed lists, tables and bounds."""

# --- fixed values: quality bounds -------------------------------------------------------------
PRICE_M2_MIN = 1_000
PRICE_M2_MAX = 2_000_000
ZONE_MAX_LENGTH = 30

# --- fixed values: names of the reasons, in the order of the rules ----------------------------
REASONS = (
    "zone_trop_longue", "zone_invalide", "zone_description_lieu", "prix_ou_surface_manquant",
    "prix_m2_trop_eleve", "prix_m2_trop_bas",
)

# --- fixed values: patterns -------------------------------------------------------------------
ROOM_PREFIX = r"^(\d+)\s*chambre"
NOT_A_PRICE = r"[^\d.]"

# --- fixed values: columns of the comparison table --------------------------------------------
TABLE_COLUMNS = (
    "zone_nom", "zone", "type_bien", "type_offre", "prix_moyen_m2", "prix_median_m2",
    "nombre_annonces", "ecart_valeur_venale",
)

# --- fixed values: words that make a zone a description of a place ----------------------------
SUSPICIOUS_WORDS = (
    "pharmacie", "cote de", "juste", "derriere", "face a", "avant", "apres", "carrefour",
    "forever", "standing", "meuble", "cuisine", "clinique", "goudron", "pave",
    "boulevard circulaire", "non loin", "a cote",
)

# --- fixed values: the shorter word list used when profiling raw zones ------------------------
PROFILE_WORDS = (
    "pharmacie", "cote de", "juste", "derriere", "face", "avant", "carrefour", "forever",
    "standing", "clinique", "goudron",
)

# --- fixed values: zones ----------------------------------------------------------------------
INVALID_ZONES = ("non spécifié", "non spécifiés", "togo", "nan", "", "none", "null")
UNKNOWN_ZONES_V1 = ("non spécifié", "non spécifiés", "")
NOT_A_ZONE = ("non spécifié", "non spécifiés", "", "nan")
PROFILE_UNKNOWN_ZONE = "non spécifié"

# --- fixed values: raw header -> canonical column ---------------------------------------------
LISTING_COLUMNS = {
    "Titre": "titre",
    "Type d'offre": "type_offre",
    "Type de bien": "type_bien",
    "Quartier": "zone",
    "Prix": "prix",
    "Piece": "pieces",
    "Surface": "surface_m2",
}
OFFICIAL_COLUMNS = {
    "Préfecture": "prefecture",
    "Zone": "zone_admin",
    "Quartier": "zone",
    "Valeur vénale (FCFA)": "prix",
    "Surface (m²)": "surface_m2",
    "Valeur/m² (FCFA)": "prix_m2_officiel",
}

# --- fixed values: property types, cleaning stage ---------------------------------------------
PROPERTY_TYPES = {
    "chambre": "Chambre",
    "chambre meublee": "Chambre",
    "chambre non meublee": "Chambre",
    "studio": "Studio",
    "1 chambre": "Maison",
    "2 chambres": "Maison",
    "3 chambres": "Maison",
    "4 chambres": "Maison",
    "5 chambres": "Maison",
    "6 chambres": "Maison",
    "1chambre": "Maison",
    "2chambre": "Maison",
    "3chambre": "Maison",
    "4chambre": "Maison",
    "5chambre": "Maison",
    "6chambre": "Maison",
    "1 chambre a coucher": "Maison",
    "2 chambres a coucher": "Maison",
    "3 chambres a coucher": "Maison",
    "4 chambres a coucher": "Maison",
    "maison": "Maison",
    "maisons": "Maison",
    "villa": "Villa",
    "villas": "Villa",
    "villa moderne": "Villa",
    "villa duplex": "Villa",
    "appartement": "Appartement",
    "appartements": "Appartement",
    "appart": "Appartement",
    "appartement meuble": "Appartement",
    "terrain": "Terrain",
    "terrains": "Terrain",
    "terrain agricole": "Terrain Agricole",
    "terrains agricoles": "Terrain Agricole",
    "terrain a batir": "Terrain",
    "bureau": "Bureau",
    "bureaux": "Bureau",
    "boutique": "Boutique",
    "boutiques": "Boutique",
    "magasin": "Magasin",
    "commerce": "Commerce",
    "local commercial": "Commerce",
    "immeuble": "Immeuble",
    "immeubles": "Immeuble",
    "immeuble de rapport": "Immeuble",
    "entrepot": "Entrepot",
    "entrepôt": "Entrepot",
    "chambre salon": "Chambre Salon",
    "1 chambre salon": "Maison",
    "2 chambres salon": "Maison",
    "3 chambres salon": "Maison",
    "4 chambres salon": "Maison",
    "1chambre salon": "Maison",
    "2chambre salon": "Maison",
    "3chambre salon": "Maison",
    "bureau/commerce": "Commerce",
    "espace commercial": "Commerce",
    "immeuble commercial": "Immeuble",
    "terrain urbain": "Terrain",
    "bar": "Bar",
    "hotel": "Hotel",
    "ecole": "Ecole",
    "station": "Station Service",
    "studio meuble": "Studio",
    "studio meublé": "Studio",
    "villa meublee": "Villa",
    "villa meublée": "Villa",
    "appartement meublé": "Appartement",
    "chambre meublée": "Chambre",
}

# --- fixed values: property types, loading stage ----------------------------------------------
PROPERTY_TYPES_AT_LOAD = {
    "chambre": "Chambre",
    "chambres": "Chambre",
    "chambre meublee": "Chambre",
    "chambre meublée": "Chambre",
    "studio": "Studio",
    "studio meuble": "Studio",
    "studio meublé": "Studio",
    "chambre salon": "Chambre Salon",
    "1 chambre": "Maison",
    "2 chambres": "Maison",
    "3 chambres": "Maison",
    "4 chambres": "Maison",
    "5 chambres": "Maison",
    "6 chambres": "Maison",
    "1chambre": "Maison",
    "2chambre": "Maison",
    "3chambre": "Maison",
    "1 chambre salon": "Maison",
    "2 chambres salon": "Maison",
    "3 chambres salon": "Maison",
    "4 chambres salon": "Maison",
    "maison": "Maison",
    "maisons": "Maison",
    "villa": "Villa",
    "villas": "Villa",
    "villa moderne": "Villa",
    "villa meublee": "Villa",
    "villa meublée": "Villa",
    "appartement": "Appartement",
    "appartements": "Appartement",
    "appartement meuble": "Appartement",
    "appartement meublé": "Appartement",
    "terrain": "Terrain",
    "terrains": "Terrain",
    "terrain urbain": "Terrain",
    "terrain agricole": "Terrain Agricole",
    "terrains agricoles": "Terrain Agricole",
    "bureau": "Bureau",
    "bureaux": "Bureau",
    "bureau/commerce": "Commerce",
    "espace commercial": "Commerce",
    "boutique": "Boutique",
    "boutiques": "Boutique",
    "magasin": "Magasin",
    "commerce": "Commerce",
    "immeuble": "Immeuble",
    "immeubles": "Immeuble",
    "immeuble commercial": "Immeuble",
    "entrepot": "Entrepot",
    "entrepôt": "Entrepot",
    "bar": "Bar",
    "hotel": "Hotel",
    "ecole": "Ecole",
    "station": "Station Service",
}
UNSPECIFIED_TYPE = "Non specifie"
UNKNOWN_AT_LOAD = "Inconnu"

# --- fixed values: sources --------------------------------------------------------------------
LISTING_SOURCES = ("immoask", "facebook", "coinafrique")
OFFICIAL_SOURCE = "ValeursVenales"
SOURCE_NAMES = {
    "immoask": "ImmoAsk",
    "facebook": "Facebook",
    "coinafrique": "CoinAfrique",
    "valeursvenales": "ValeursVenales",
}

# --- fixed values: constant columns of the star schema ----------------------------------------
COMMUNE = "Lome"
PREFECTURE = "GOLFE"
COLLECTION_DATE = "2024-01-01"
GLOBAL_PERIOD = "GLOBAL"

# --- fixed values: text widths of the rejects table -------------------------------------------
REJECT_WIDTHS = {
    "titre": 255,
    "zone": 255,
    "type_bien": 100,
    "type_offre": 50,
    "source": 100,
    "raison_rejet": 100,
}
TITLE_WIDTH = 255

# --- fixed values: index labels and thresholds ------------------------------------------------
INDEX_HIGH = 105
INDEX_LOW = 95
TREND_LABELS = ("HAUSSE", "BAISSE", "STABLE")
POSITION_LABELS = ("Au dessus de la moyenne", "En dessous de la moyenne", "Dans la moyenne")

# --- fixed values: map coordinates (zone, latitude, longitude) --------------------------------
ZONE_COORDINATES = (
    ("baguida", 6.1167, 1.3500),
    ("agoe", 6.1900, 1.2200),
    ("adidogome", 6.1700, 1.2000),
    ("adetikope", 6.2200, 1.1800),
    ("be", 6.1300, 1.2300),
    ("tokoin", 6.1500, 1.2100),
    ("djidjole", 6.1600, 1.1900),
    ("nyekonakpoe", 6.1400, 1.2200),
    ("hedzranawoe", 6.1350, 1.2150),
    ("ablogame", 6.1250, 1.2050),
    ("kodjoviakope", 6.1200, 1.2100),
    ("aflao", 6.1050, 1.1950),
    ("kegue", 6.1450, 1.2300),
    ("nukafu", 6.1550, 1.2400),
    ("zanguera", 6.1650, 1.2500),
    ("cacaveli", 6.1500, 1.2600),
    ("lome", 6.1375, 1.2123),
    ("bè", 6.1300, 1.2300),
)
