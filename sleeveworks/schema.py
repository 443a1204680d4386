"""Column names, fixed values and table schemas shared by the whole package."""

from pyspark.sql import types as T

# --- Fixed values ---------------------------------------------------------------------------

# Spellings that a CSV reader must turn into null.
NA_SPELLINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Written where a name, composer or duration is not known.
MISSING = "missing"

# Sections and leaves of one extraction document.
GENERAL_SECTION = "General Information"
TRACK_SECTION = "Track Info"
GENERAL_FIELDS = [
    "LP_ID", "Country", "Title", "Subtitle", "Performer", "Publisher", "Publishing Year",
    "Label Company", "Label Number", "Language", "Recording Info", "Genre/Style", "Notes",
    "Other Information",
]
TRACK_FIELDS = ["Face", "Track_Number", "Track_Name", "Track_Composer", "Track_Length"]

# Country spelling -> (continent, sub-continent). Matching is exact and case-sensitive.
CONTINENTS = {
    "Spain": ("Europe", "Europe méridionale"),
    "Espagne": ("Europe", "Europe méridionale"),
    "Uruguay": ("Amérique", "Amérique du Sud"),
    "URUGUAY": ("Amérique", "Amérique du Sud"),
    "Paraguay": ("Amérique", "Amérique du Sud"),
    "Bolivia": ("Amérique", "Amérique du Sud"),
    "Bolivie": ("Amérique", "Amérique du Sud"),
    "Mexico": ("Amérique", "Amérique centrale"),
    "Mexique": ("Amérique", "Amérique centrale"),
}

SUPPORT = "Disque 33 tours"
FORMAT = "Format 30 cm"
SHELFMARK_SUFFIX = "-1/1"

# Columns of the general catalogue in file order.
GENERAL_CATALOGUE = [
    "Côte générale", "Localisation", "Support", "Format", "Continent", "Sub-continent", "Pays",
    "Région", "Localité", "Population", "Titre", "Sous-Titre", "Traduction", "Interprète",
    "Genre, occasion", "Instruments", "Production", "Collection", "Année de production",
    "Numéro édition", "Auteur du livret", "Langue", "Photos", "Pages", "Collectage",
    "Commentaire", "date création fiche", "parrain", "Nombre de support", "Autre pays",
    "Ancien numéro", "Correspondance DAT", "Edition", "Année édition", "Lieu production",
    "Lieu édition", "Numéro de support", "No Matrice", "cote", "copyrights",
    "exclure de la consultation", "ai_info_1_notes", "ai_info_2_other_info",
]

# Columns of the track catalogue in file order.
TRACK_CATALOGUE = [
    "Cote", "FileName_TBD", "Face", "Plage", "Titre", "Durée", "ai_info_track_composer",
    "ai_Plage_combined",
]

# Slots of one record: two sides with up to six tracks each.
FACES = ["A", "B"]
SLOTS_PER_FACE = 6

# --- Schemas --------------------------------------------------------------------------------


def strings(names: list[str]) -> T.StructType:
    """A schema of nullable strings."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_GENERAL = strings(GENERAL_FIELDS)
RAW_TRACK = strings([
    "LP_ID", "Face", "Track Number", "Track_Name", "Track_Composer", "Track_Length",
    "Track Length", "Track Filename",
])
_INTEGER_COLUMNS = {"Nombre de support", "copyrights", "exclure de la consultation"}
CLEAN_GENERAL = T.StructType([
    T.StructField(n, T.LongType() if n in _INTEGER_COLUMNS else T.StringType())
    for n in GENERAL_CATALOGUE
])
CLEAN_TRACK = strings(TRACK_CATALOGUE)
