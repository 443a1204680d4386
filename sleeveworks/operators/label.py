"""Projection of raw album and track rows to the catalogue columns."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleeveworks.functions import scalars as S
from sleeveworks.operators.skew import lookup
from sleeveworks.schema import CONTINENTS, FORMAT, GENERAL_CATALOGUE, SUPPORT

def with_continent(df: DataFrame, country: str = "Country", names: DataFrame | None = None) -> DataFrame:
    """Add ``continent`` and ``sub_continent`` by exact spelling.

    Without ``names`` the built-in spellings are used, as an expression. ``names`` is a table
    (country, continent, sub_continent); of rows that repeat a spelling the least counts.
    """
    if names is None:
        continent, sub = S.continent(F.col(country), CONTINENTS)
        return df.withColumn("continent", continent).withColumn("sub_continent", sub)
    least = F.min(F.struct("continent", "sub_continent")).alias("_least")
    facts = names.groupBy(F.col("country").alias(country)).agg(least).select(country, "_least.*")
    return lookup(df, facts, [country]).select(*df.columns, "continent", "sub_continent")


def general_catalogue(albums: DataFrame, curator: str, note: str, as_of: dt.date,
                      names: DataFrame | None = None) -> DataFrame:
    """The album catalogue from raw album rows that carry ``support_count``."""
    today = F.lit(as_of)
    rows = with_continent(albums, names=names)
    values: dict[str, Column] = {
        "Côte générale": F.col("LP_ID"),
        "Support": F.lit(SUPPORT),
        "Format": F.lit(FORMAT),
        "Continent": F.col("continent"),
        "Sub-continent": F.col("sub_continent"),
        "Pays": S.capitalise(F.col("Country")),
        "Titre": F.col("Title"),
        "Sous-Titre": F.col("Subtitle"),
        "Interprète": F.col("Performer"),
        "Production": F.col("Publisher"),
        "Année de production": F.col("Publishing Year"),
        "Numéro édition": F.col("Label Number"),
        "Langue": F.col("Language"),
        "Collectage": F.col("Recording Info"),
        "Commentaire": S.curation_comment(note, curator, today),
        "date création fiche": S.full_date(today),
        "parrain": F.lit(curator),
        "Nombre de support": F.col("support_count"),
        "Edition": F.col("Label Company"),
        "cote": S.shelfmark(F.col("LP_ID")),
        "copyrights": F.lit(0).cast("bigint"),
        "exclure de la consultation": F.lit(0).cast("bigint"),
        "ai_info_1_notes": F.col("Notes"),
        "ai_info_2_other_info": F.col("Other Information"),
    }
    unknown = F.lit(None).cast("string")
    return rows.select(*[values.get(c, unknown).alias(c) for c in GENERAL_CATALOGUE])


def track_catalogue(tracks: DataFrame, parity: bool = False) -> DataFrame:
    """The track catalogue from raw track rows with file name and length."""
    return tracks.select(
        F.col("LP_ID").alias("Cote"),
        F.col("Track Filename").alias("FileName_TBD"),
        F.col("Face"),
        F.col("Track Number").alias("Plage"),
        F.col("Track_Name").alias("Titre"),
        F.col("Track Length").alias("Durée"),
        F.col("Track_Composer").alias("ai_info_track_composer"),
        S.name_and_composer(F.col("Track_Name"), F.col("Track_Composer"), parity).alias("ai_Plage_combined"),
    )
