"""Matching tracks to audio files, filling slots, counting tracks, skipping finished work."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleeveworks.functions import scalars as S
from sleeveworks.operators.skew import hot_keys, lookup
from sleeveworks.schema import FACES, MISSING, SLOTS_PER_FACE


def inventory(files: DataFrame) -> DataFrame:
    """One row per (album, file); the shortest reading wins where a file is listed twice."""
    return files.groupBy("lp_id", "file_name").agg(F.min("seconds").alias("seconds"))


def match_exact(tracks: DataFrame, audio: DataFrame, parity: bool = False,
                hot: DataFrame | None = None) -> DataFrame:
    """Add ``Track Filename`` (the name the file should have) and ``Track Length``.

    ``tracks`` has LP_ID, Face and track_no; ``audio`` is one row per (lp_id, file_name).
    """
    named = with_audio_name(tracks, parity)
    facts = audio.select(F.col("lp_id").alias("LP_ID"), F.col("file_name").alias("Track Filename"), "seconds")
    found = lookup(named, facts, ["LP_ID", "Track Filename"], hot=hot)
    return found.withColumn("Track Length", S.duration_text(F.col("seconds"))).drop("seconds")


def with_audio_name(tracks: DataFrame, parity: bool = False) -> DataFrame:
    return tracks.withColumn(
        "Track Filename", S.audio_name(F.col("LP_ID"), F.col("Face"), F.col("track_no"), parity))


def match_with_fallback(tracks: DataFrame, audio: DataFrame, hot_slots: DataFrame | None = None,
                        hot_albums: DataFrame | None = None) -> DataFrame:
    """Add ``File_Name`` and ``Track_Length``: the file of the track's (face, number), else the
    first file of the album by name, else ``missing``."""
    file = F.struct(F.col("file_name"), F.col("seconds"))
    code = S.legacy_slot_code(F.col("lp_id"), F.col("file_name"))
    # Exploded rather than filtered, so that the name is parsed once.
    coded = audio.select(F.col("lp_id").alias("LP_ID"), file.alias("_file"),
                         F.explode(F.array_compact(F.array(code))).alias("_code"))
    slots = (
        coded.select("LP_ID", S.code_face(F.col("_code")).alias("Face"),
                     S.zero_pad(S.code_number(F.col("_code"))).alias("track_no"), "_file")
        .groupBy("LP_ID", "Face", "track_no").agg(F.min("_file").alias("_exact"))
    )
    albums = audio.groupBy(F.col("lp_id").alias("LP_ID")).agg(F.min(file).alias("_any"))
    # Hot albums are looked for in the tracks themselves, not behind the first join.
    hot_albums = hot_keys(tracks, ["LP_ID"]) if hot_albums is None else hot_albums
    found = lookup(tracks, slots, ["LP_ID", "Face", "track_no"], hot=hot_slots)
    found = lookup(found, albums, ["LP_ID"], hot=hot_albums)
    best = F.coalesce("_exact", "_any")
    return found.select(
        *tracks.columns,
        F.coalesce(best["file_name"], F.lit(MISSING)).alias("File_Name"),
        S.duration_text(best["seconds"]).alias("Track_Length"),
    )


def _slot_files(audio: DataFrame, albums: DataFrame | None, faces: list[str], slots: int) -> DataFrame:
    """One row per album with one struct per slot.

    Each slot is a conditional minimum, so every task reduces its input to one row per album
    before the only shuffle, and no album is ever collected.
    """
    coded = audio.withColumn("_code", S.slot_code(F.col("file_name")))
    files = coded.select("lp_id", S.code_face(F.col("_code")).alias("face"),
                         S.code_number(F.col("_code")).try_cast("int").alias("plage"),
                         F.struct("file_name", "seconds").alias("file"))
    if albums is not None:
        files = files.unionByName(albums.select("lp_id"), allowMissingColumns=True)
    return files.groupBy("lp_id").agg(*[
        F.min(F.when((F.col("face") == f) & (F.col("plage") == p), F.col("file"))).alias(f"{f}{p}")
        for f in faces for p in range(1, slots + 1)
    ])


def _slot_array(faces: list[str], slots: int) -> Column:
    return F.array(*[
        F.struct(
            F.lit(f).alias("face"), F.lit(p).alias("plage"), F.col(f"{f}{p}.file_name").alias("file_name"),
            F.when(F.col(f"{f}{p}").isNotNull(), S.duration_text(F.col(f"{f}{p}.seconds"))).alias("duration"),
        )
        for f in faces for p in range(1, slots + 1)
    ])


def slot_grid(audio: DataFrame, albums: DataFrame | None = None, faces: list[str] = FACES,
              slots: int = SLOTS_PER_FACE) -> DataFrame:
    """Every slot of every album, with its file or nulls.

    ``albums`` adds albums that have no file at all. Other faces and higher numbers are left out.
    """
    wide = _slot_files(audio, albums, faces, slots)
    return wide.select("lp_id", F.inline(_slot_array(faces, slots)))


def nested_slots(audio: DataFrame, albums: DataFrame | None = None, faces: list[str] = FACES,
                 slots: int = SLOTS_PER_FACE) -> DataFrame:
    """One row per album: shelfmark and the array of all its slots."""
    wide = _slot_files(audio, albums, faces, slots)
    return wide.select(S.shelfmark_of_folder(F.col("lp_id")).alias("cote"), _slot_array(faces, slots).alias("slots"))


def track_counts(tracks: DataFrame, key: str = "LP_ID") -> DataFrame:
    return tracks.groupBy(key).agg(F.count(F.lit(1)).alias("n_tracks"))


def with_support_count(albums: DataFrame, tracks: DataFrame, key: str = "LP_ID",
                       unique: bool = False) -> DataFrame:
    """Add ``support_count``: track rows of the album, at least 1. ``unique``: an album is one row."""
    counted = lookup(albums, track_counts(tracks, key), [key], unique=unique)
    n = F.greatest(F.coalesce("n_tracks", F.lit(0)), F.lit(1))
    return counted.withColumn("support_count", n.cast("bigint")).drop("n_tracks")


def not_done(inputs: DataFrame, done: DataFrame, on: list[str], unique: bool = False) -> DataFrame:
    """Inputs without an output yet. ``unique``: an input is one row."""
    return lookup(inputs, done.select(*on).distinct(), on, how="left_anti", unique=unique)
