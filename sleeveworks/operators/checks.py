"""Contract report: how many rows break the formats that the extraction is asked to follow, which rows these
are, and which track numbers a side lacks."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sleeveworks.schema import FACES, SLOTS_PER_FACE


def general_rules() -> dict[str, Column]:
    """Rule name -> condition that holds for a good album row."""
    return {
        "lp_id_format": F.col("LP_ID").rlike("^LP[0-9]{4}$"),
        "label_number_format": F.col("Label Number").rlike("^[A-Za-z]{2,3}[^A-Za-z0-9]*[0-9]+$"),
    }


def track_rules() -> dict[str, Column]:
    """Rule name -> condition that holds for a good track row."""
    return {
        "face_known": F.col("Face").isin(FACES),
        "track_number_whole": F.col("Track Number").rlike("^[0-9]+$"),
        # What the slot grid has no place for.
        "slot_in_grid": F.col("Face").isin(FACES)
        & F.regexp_extract("Track Number", "[0-9]+", 0).try_cast("int").between(1, SLOTS_PER_FACE),
    }


def _broken(good: Column) -> Column:
    """Null breaks a rule."""
    return ~F.coalesce(good, F.lit(False))


def _as_rows(counts: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``rule, checked, violations`` from one row of counts; ``rules`` names what was checked."""
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.coalesce(checked, F.lit(0)).alias("checked"),
                 F.coalesce(rule, F.lit(0)).alias("violations"))
        for rule, checked in rules.items()])))


def contract_report(albums: DataFrame, tracks: DataFrame, per_face: int = SLOTS_PER_FACE) -> DataFrame:
    """``rule, checked, violations`` over raw album rows and raw track rows, each read once.

    ``tracks_per_face`` checks every (album, face) that has tracks; ``album_id_unique`` counts the album
    rows whose id another row has, ``slot_in_grid`` the tracks that the slot grid leaves out.
    """
    album_rules, row_rules = general_rules(), track_rules()
    by_id = albums.groupBy("LP_ID").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(_broken(good)).alias(r) for r, good in album_rules.items()])
    album_counts = by_id.agg(
        F.sum("n").alias("n"), *[F.sum(r).alias(r) for r in album_rules],
        F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("album_id_unique"))
    sides = tracks.groupBy("LP_ID", "Face").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(_broken(good)).alias(r) for r, good in row_rules.items()])
    track_counts = sides.agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("sides"), *[F.sum(r).alias(r) for r in row_rules],
        F.count_if(F.col("n") != per_face).alias("tracks_per_face"))
    return _as_rows(album_counts, dict.fromkeys([*album_rules, "album_id_unique"], "n")).unionByName(
        _as_rows(track_counts, {**dict.fromkeys(row_rules, "rows"), "tracks_per_face": "sides"}))


#: The column each rule is about.
_ABOUT = {"lp_id_format": "LP_ID", "label_number_format": "Label Number", "face_known": "Face",
          "track_number_whole": "Track Number", "slot_in_grid": "Track Number"}


def _breaches(rows: DataFrame, rules: dict[str, Column], seq: Column) -> DataFrame:
    found = F.array_compact(F.array(*[
        F.when(_broken(good), F.struct(F.lit(rule).alias("rule"), F.col(f"`{_ABOUT[rule]}`").alias("value")))
        for rule, good in rules.items()]))
    return rows.select("LP_ID", seq.cast("int").alias("seq"), F.inline(found))


def violations(albums: DataFrame, tracks: DataFrame) -> DataFrame:
    """``LP_ID, seq, rule, value``: one row per album or track row and rule that it breaks by itself, with the value at
    fault. ``seq`` is the track's place in its document, null for albums. Each table is read once, without a shuffle."""
    return _breaches(albums, general_rules(), F.lit(None)).unionByName(_breaches(tracks, track_rules(), F.col("seq")))


def _numbers(tracks: DataFrame) -> DataFrame:
    """The different track numbers of every album side, from 1 on."""
    number = F.col("track_no").try_cast("int")
    return tracks.select("LP_ID", "Face", number.alias("n")).where("n >= 1").distinct()


def track_runs(tracks: DataFrame) -> DataFrame:
    """``LP_ID, Face, first, last``: stretches of consecutive track numbers of every side.

    Sides are reduced to their different numbers before anything is ordered. Tracks without a number are left out.
    """
    within = W.partitionBy("LP_ID", "Face")
    placed = _numbers(tracks).withColumn("run", F.col("n") - F.row_number().over(within.orderBy("n")))
    return placed.groupBy("LP_ID", "Face", "run").agg(F.min("n").alias("first"), F.max("n").alias("last")).drop("run")


def track_gaps(tracks: DataFrame) -> DataFrame:
    """``LP_ID, Face, first_missing, last_missing``: the numbers that a side lacks below its highest."""
    before = F.lag("n", 1, 0).over(W.partitionBy("LP_ID", "Face").orderBy("n"))
    return _numbers(tracks).withColumn("before", before).where("n > before + 1").select(
        "LP_ID", "Face", (F.col("before") + 1).alias("first_missing"), (F.col("n") - 1).alias("last_missing"))
