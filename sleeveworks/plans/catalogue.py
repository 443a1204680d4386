"""The four stages from cover images and audio files to the two catalogue tables.

Recognised texts and model responses come from paid calls. Open work is done in portions, each written
to a table of attempts before the next begins; what an earlier run left unparsed is parsed first, and
only what has no usable answer yet is asked for. Then raw rows, tracks with files and the catalogues
are written, one table after the other.
"""

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sleeveworks.functions import scalars as S
from sleeveworks.functions.text import cover_text
from sleeveworks.operators import covers, extract, label, match, select
from sleeveworks.operators.enrich import enrich, on_contents
from sleeveworks.schema import RAW_GENERAL, RAW_TRACK
from sleeveworks.session import new_shared_path, tune
from sleeveworks.sources import files
from sleeveworks.sources import manifest as M
from sleeveworks.sources.places import remove
from sleeveworks.sources.sinks import append_table, export_files, write_csv, write_table


def keyed(responses: DataFrame) -> DataFrame:
    """Responses with the album id of their file name."""
    return responses.withColumn("lp_id", S.lp_id_of_file(F.col("file_name")))


def raw_tracks(responses: DataFrame, how: str = "greedy", coerce_numbers: bool = True) -> DataFrame:
    return extract.track_rows(extract.parse_documents(responses, how=how), coerce_numbers=coerce_numbers)


def raw_albums(responses: DataFrame, how: str = "greedy") -> DataFrame:
    return extract.general_rows(extract.parse_documents(responses, how=how))


def tracks_with_audio(responses: DataFrame, audio: DataFrame, how: str = "greedy",
                      parity: bool = False) -> DataFrame:
    """Raw track rows with the file each should have and its duration.

    The rows are written down first: the responses are decoded once, and what the lookup counts to
    stay balanced are two columns of a table.
    """
    path = new_shared_path(responses.sparkSession, "tracks")
    write_table(raw_tracks(responses, how, coerce_numbers=not parity), path)
    return match.match_exact(responses.sparkSession.read.parquet(path), audio, parity)


def albums_with_support(responses: DataFrame, tracks: DataFrame, how: str = "greedy") -> DataFrame:
    """Raw album rows with their support count.

    The rows are written down first, as the lookup reads them twice: the responses are decoded once.
    """
    path = new_shared_path(responses.sparkSession, "albums")
    write_table(raw_albums(responses, how), path)
    return match.with_support_count(responses.sparkSession.read.parquet(path), tracks)


def in_order(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows by natural order of the album and, where they have one, their place in its document. ``parts``: as many
    tasks share the sort, however well the rows compress; else Spark chooses by bytes."""
    order = [*select.natural_order("LP_ID"), *([F.col("seq")] if "seq" in rows.columns else [])]
    return rows.orderBy(*order) if parts is None else rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def recognise(pairs: DataFrame, make_reader: Callable[[], Callable[[Any], str]], **calling: Any) -> DataFrame:
    """Text of both covers of each album. An unreadable cover counts as empty; the error is kept.
    ``calling``: how calls are made, see ``enrich``."""
    read = enrich(pairs, make_reader, {"front_text": "front_path", "back_text": "back_path"}, **calling)
    return read.withColumn("combined_text", cover_text(F.col("front_text"), F.col("back_text")))


def infer(texts: DataFrame, template: str, make_model: Callable[[], Callable[[Any], str]], **calling: Any) -> DataFrame:
    """Model response to each text. ``calling``: how calls are made, see ``enrich``."""
    asked = texts.withColumn("prompt", S.render_prompt(template, F.col("combined_text")))
    return enrich(asked, make_model, {"response": "prompt"}, **calling).drop("prompt")


@dataclass
class Run:
    """One run over a folder of albums, with its tables below ``work_dir``."""

    spark: SparkSession
    base_dir: str
    work_dir: str
    curator: str
    note: str
    as_of: dt.date
    workers: int | None = None
    calls_per_minute: float | None = None
    parity: bool = False
    # Calls at a time of each worker, and seconds after which one is given up.
    in_flight: int = 1
    timeout: float | None = None
    # Rows asked for between two commits, about.
    portion: int = 10_000

    def __post_init__(self) -> None:
        tune(self.spark)

    def path(self, name: str) -> str:
        return f"{self.work_dir}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _stored(self, name: str, *keys: str) -> DataFrame:
        """Keys in a table, none if it does not exist yet, or only as what a write that failed left."""
        try:
            return self.table(name).select(*keys)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            return self.spark.createDataFrame([], ", ".join(f"{k} string" for k in keys))

    def manifest(self, inventory: DataFrame | None = None) -> DataFrame:
        """Files below ``base_dir``, listed, or from an ``inventory`` (path, length, modified)."""
        return M.manifest(M.scan_files(self.spark, self.base_dir) if inventory is None else inventory, self.base_dir)

    def _in_portions(self, todo: DataFrame, ask: Callable[[DataFrame], DataFrame], name: str) -> None:
        """Answers to the open work, each portion of it committed before the next is asked for.

        The open work is written down first, so that every portion is a fixed share of it. Attempts
        are never read by a portion that is still running: each has a folder of its own. Answers of a
        portion that breaks off are in the ledger, where the next run finds them.
        """
        path = new_shared_path(self.spark, "todo")
        write_table(todo, path)
        work = self.spark.read.schema(todo.schema).parquet(path)
        portions = -(-work.count() // self.portion)
        for i in range(portions):
            share = work.where(F.pmod(F.xxhash64("lp_id"), F.lit(portions)) == i)
            stamp = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}"
            write_table(ask(share), self.path(f"{name}/attempt={stamp}-{i}"))
        # All answers are in the table now; one that turns out unusable may be asked for again.
        remove(self.spark, self._ledger(name))

    def _ledger(self, name: str) -> str:
        return self.path(f"ledger/{name}")

    def _calling(self, name: str) -> dict[str, Any]:
        return {"workers": self.workers, "calls_per_minute": self.calls_per_minute, "in_flight": self.in_flight,
                "timeout": self.timeout, "ledger": self._ledger(name)}

    def recognise_covers(self, make_reader: Callable[[], Callable[[Any], str]], selection: str = "all",
                         inventory: DataFrame | None = None, contents: bool = False) -> None:
        """Stage 1: texts of the selected albums that have both covers and no text yet. An album of which
        a cover could not be read is tried again by the next run. With ``contents`` the reader gets the
        bytes of an image, else its path."""
        make_reader = on_contents(make_reader) if contents else make_reader
        self._keep_texts()
        found = self.manifest(inventory)
        chosen = select.select_positions(select.album_names(found), selection, parity=self.parity)
        pairs = covers.complete_pairs(covers.cover_pairs(found)).join(chosen, "lp_id", "left_semi")
        todo = match.not_done(pairs, self._stored("ocr_text", "lp_id"), ["lp_id"], unique=True)
        self._in_portions(todo, lambda rows: recognise(rows, make_reader, **self._calling("ocr_attempts"))
                          .drop("front_path", "back_path"), "ocr_attempts")
        self._keep_texts()

    def _keep_texts(self) -> None:
        """Complete readings among the attempts become texts, one per album."""
        tried = self._stored("ocr_attempts", "lp_id", "combined_text", "front_text_error", "back_text_error")
        read = tried.where("front_text_error IS NULL AND back_text_error IS NULL").groupBy("lp_id").agg(
            F.min("combined_text").alias("combined_text")).withColumn("file_name", F.concat("lp_id", F.lit("_combined.txt")))
        append_table(match.not_done(read, self._stored("ocr_text", "lp_id"), ["lp_id"], unique=True), self.path("ocr_text"))

    def ask_model(self, template: str, make_model: Callable[[], Callable[[Any], str]]) -> None:
        """Stage 2: responses for texts whose document is not there yet. Failed or empty answers are asked again."""
        self._parse_responses()
        texts = self.table("ocr_text").select("lp_id", S.output_name(F.col("file_name")).alias("file_name"), "combined_text")
        todo = match.not_done(texts, self._stored("extractions", "file_name"), ["file_name"], unique=True)
        self._in_portions(todo, lambda rows: infer(rows, template, make_model, **self._calling("responses"))
                          .drop("combined_text"), "responses")
        self._parse_responses()

    def _parse_responses(self) -> None:
        """Documents out of all responses that have not been parsed yet, also those of a run that broke off."""
        paid = self._stored("responses", "lp_id", "file_name", "response", "response_error", "attempt")
        paid = paid.withColumn("attempt", F.col("attempt").cast("string"))
        done = self._stored("parsed", "file_name", "attempt")
        path = new_shared_path(self.spark, "unparsed")
        write_table(match.not_done(paid, done, ["file_name", "attempt"], unique=True), path)
        fresh = self.spark.read.schema(paid.schema).parquet(path)
        self._store_documents(extract.parse_documents(fresh))
        append_table(fresh.select("file_name", "attempt"), self.path("parsed"))

    def _store_documents(self, parsed: DataFrame) -> None:
        """Documents by the name of their file, sub-folders included, each once; unusable ones by name and reason."""
        found = extract.found_documents(parsed).select("lp_id", "file_name", "doc_json").dropDuplicates(["file_name"])
        bad = extract.quarantine(parsed).select("lp_id", "file_name", "response", "reason").dropDuplicates(["file_name", "reason"])
        append_table(match.not_done(found, self._stored("extractions", "file_name"), ["file_name"], unique=True), self.path("extractions"))
        append_table(match.not_done(bad, self._stored("unreadable", "file_name", "reason"), ["file_name", "reason"], unique=True),
                     self.path("unreadable"))

    def load_texts(self, directory: str) -> None:
        """Instead of stage 1: ``<album>_combined.txt`` files that exist already. A file is known by its path
        below ``directory``, so two texts of an album are two texts, each with a document of its own."""
        texts = files.read_texts(self.spark, directory).select("lp_id", "combined_text", "file_name")
        append_table(match.not_done(texts, self._stored("ocr_text", "file_name"), ["file_name"], unique=True), self.path("ocr_text"))

    def load_documents(self, directory: str) -> None:
        """Instead of stage 2: extraction documents that exist already, one JSON file each. A file is
        known by its path below ``directory``, so a second document of an album is loaded too, also one of the same
        name in another sub-folder."""
        self._store_documents(files.read_documents(self.spark, directory))

    def export(self, directory: str) -> None:
        """The intermediate results as files: a text and a JSON file per album, raw tables as CSV."""
        export_files(self.table("ocr_text"), f"{directory}/texts", "file_name", "combined_text")
        export_files(self.table("extractions"), f"{directory}/documents", "file_name", "doc_json")
        albums, tracks = self.table("raw_general"), self.table("tracks_with_audio")
        write_csv(in_order(albums).select(*RAW_GENERAL.names), f"{directory}/general_info")
        write_csv(in_order(tracks).select(*RAW_TRACK.names), f"{directory}/track_info")

    def measure_audio(self, make_header: Callable[[], Callable[[bytes], float]], inventory: DataFrame | None = None) -> None:
        """Seconds of every audio file, from its bytes; a file that can't be read has none."""
        found = M.audio_files(self.manifest(inventory)).select("lp_id", "file_name", "path")
        measured = enrich(found, on_contents(make_header), {"seconds": "path"}, DoubleType(), self.workers,
                          in_flight=self.in_flight, timeout=self.timeout)
        write_table(measured.drop("path"), self.path("audio"))

    def flatten(self, audio: DataFrame | None = None) -> None:
        """Stage 3: raw album and track tables, and tracks with their files. ``audio`` (lp_id, file_name,
        seconds) is what ``measure_audio`` found, if not given."""
        audio = self.table("audio").select("lp_id", "file_name", "seconds") if audio is None else audio
        parsed = extract.parse_documents(self.table("extractions"), text="doc_json", how="whole")
        write_table(extract.general_rows(parsed, extra="other_members"), self.path("raw_general"))
        write_table(extract.track_rows(parsed, coerce_numbers=not self.parity, extra="other_members"), self.path("raw_tracks"))
        matched = match.match_exact(self.table("raw_tracks"), match.inventory(audio), self.parity)
        write_table(matched, self.path("tracks_with_audio"))

    def label(self) -> None:
        """Stage 4: the two catalogues, as CSV."""
        self._label(self.table("raw_general"), self.table("tracks_with_audio"))

    def label_csv(self, directory: str) -> None:
        """Stage 4 from exported, perhaps corrected, raw CSV tables."""
        tracks = files.read_csv(self.spark, f"{directory}/track_info", RAW_TRACK)
        # The order of an album's tracks is that of its lines.
        self._label(files.read_csv(self.spark, f"{directory}/general_info", RAW_GENERAL),
                    tracks.withColumn("seq", F.monotonically_increasing_id()))

    def _label(self, albums: DataFrame, tracks: DataFrame) -> None:
        counted = match.with_support_count(albums, tracks)
        write_csv(label.general_catalogue(in_order(counted), self.curator, self.note, self.as_of), self.path("general_catalogue"))
        write_csv(label.track_catalogue(in_order(tracks), self.parity), self.path("track_catalogue"))
