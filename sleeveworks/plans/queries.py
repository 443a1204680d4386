"""Every operator as a query over the benchmark tables."""

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sleeveworks.functions import scalars as S
from sleeveworks.functions import text as X
from sleeveworks.operators import checks, covers, extract, label, match, select
from sleeveworks.operators.enrich import enrich
from sleeveworks.plans import adapters as A
from sleeveworks.plans import catalogue as C
from sleeveworks.schema import strings
from sleeveworks.session import new_shared_path, tune
from sleeveworks.sources import csv_parts, files, layout, manifest, sinks
from sleeveworks.sources.places import matching, remove
from sleeveworks.streaming import arrival

CURATOR, NOTE, AS_OF = "J. Doe", "Digitised in July.", dt.date(2024, 9, 5)
TEMPLATE = "Extract the entities of this document.\n\n"
# Rows that a task sorts, and responses that it decodes, at a time, about.
ROWS_PER_TASK, DOCUMENTS_PER_TASK = 500_000, 100_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(tune(spark), sf_dir)

    QUERIES[f.__name__] = run
    return run


def _track_responses(spark, sf_dir):
    return C.keyed(_spread(spark, sf_dir, "track_responses"))


def _general_responses(spark, sf_dir):
    return C.keyed(_spread(spark, sf_dir, "general_responses"))


def _spread(spark, sf_dir, name):
    """Responses of a benchmark table, which is one small file, over all cores: each is dear to decode."""
    return A.frame(spark, sf_dir, name, spread=2 * spark.sparkContext.defaultParallelism)


def _audio(spark, sf_dir):
    return match.inventory(A.frame(spark, sf_dir, "audio_files"))


def _tracks(spark, sf_dir):
    """Track rows as the matching operators take them."""
    return A.frame(spark, sf_dir, "tracks").select(
        F.col("lp_id").alias("LP_ID"), F.col("face").alias("Face"), "track_name",
        S.track_number(F.col("raw_number")).alias("track_no"))


def _covers(spark, sf_dir):
    return manifest.manifest(A.cover_files(spark, sf_dir), "/lp")


def _albums(spark, sf_dir):
    return select.album_names(A.frame(spark, sf_dir, "albums"))


# --- The two catalogues -----------------------------------------------------------------------


@query
def track_catalogue(spark, sf_dir):
    """Catalogue row and duration for every track found in the responses."""
    return label.track_catalogue(C.tracks_with_audio(_track_responses(spark, sf_dir), _audio(spark, sf_dir)))


@query
def track_catalogue_parity(spark, sf_dir):
    """The same with unknown parts printed and bare numbers refused."""
    tracks = C.tracks_with_audio(_track_responses(spark, sf_dir), _audio(spark, sf_dir), parity=True)
    return label.track_catalogue(tracks, parity=True)


@query
def general_catalogue(spark, sf_dir):
    tracks = A.frame(spark, sf_dir, "tracks").withColumnRenamed("lp_id", "LP_ID")
    albums = C.albums_with_support(_general_responses(spark, sf_dir), tracks)
    return label.general_catalogue(albums, CURATOR, NOTE, AS_OF)


# --- JSON in responses ------------------------------------------------------------------------


@query
def extract_greedy(spark, sf_dir):
    return A.frame(spark, sf_dir, "track_responses").select(
        "file_name", X.brace_span(F.col("response")).alias("span"))


@query
def extract_fenced(spark, sf_dir):
    return A.frame(spark, sf_dir, "track_responses").select(
        "file_name", X.fenced_object(F.col("response")).alias("span"))


@query
def extract_strip(spark, sf_dir):
    return A.frame(spark, sf_dir, "track_responses").select(
        "file_name", X.fenced_body(F.col("response")).alias("body"),
        X.drop_fences(F.col("response")).alias("unfenced"))


@query
def quarantine_counts(spark, sf_dir):
    """Unusable responses by reason; chat turns stand for answers without any JSON."""
    chat = A.frame(spark, sf_dir, "chat_answers").select(F.col("text").alias("response"))
    texts = extract.union_sparse([_spread(spark, sf_dir, "track_responses").select("response"),
                                  _spread(spark, sf_dir, "general_responses").select("response"), chat])
    bad = extract.quarantine(extract.parse_documents(texts))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def default_if_absent(spark, sf_dir):
    rows = C.raw_tracks(_track_responses(spark, sf_dir))
    return rows.select("LP_ID", "seq", F.col("Track Number").alias("number"), "Track_Name", "Track_Composer")


@query
def raw_general(spark, sf_dir):
    """Album rows as extracted, one column per declared member."""
    return C.raw_albums(_general_responses(spark, sf_dir))


@query
def extraction_store(spark, sf_dir):
    """Non-empty documents to a table, back, and to track rows."""
    path = new_shared_path(spark, "extractions")
    parsed = extract.parse_documents(_spread(spark, sf_dir, "track_responses"))
    sinks.append_table(extract.found_documents(parsed).select("file_name", F.col("doc_json").alias("response")), path)
    return extract.track_rows(files.read_document_lines(spark, path)).select("LP_ID", "seq", "Face", "track_no")


@query
def member_columns(spark, sf_dir):
    """Columns that nobody declared, found in all documents of a store and typed by their values."""
    path = new_shared_path(spark, "member-schema")
    docs = A.table(spark, sf_dir, "supplier").selectExpr("'LP' || s_suppkey AS lp_id", f"{A.MEMBERS_DOCUMENT} AS response")
    parsed = extract.parse_documents(docs, how="whole")
    sinks.write_table(extract.member_schema(parsed), path)
    return extract.wide_rows(parsed, spark.read.parquet(path))


@query
def chat_content(spark, sf_dir):
    """Message text out of a chat envelope."""
    message = F.struct(F.col("role"), F.col("text").alias("content"))
    choices = F.array(F.struct(F.lit(0).alias("index"), message.alias("message"), F.lit("stop").alias("finish_reason")))
    usage = F.struct(F.length("text").alias("total_tokens"))
    wrapped = A.frame(spark, sf_dir, "chat_answers").select(
        "conv_id", "turn", F.to_json(F.struct(choices.alias("choices"), usage.alias("usage"))).alias("envelope"))
    return wrapped.select("conv_id", "turn", X.chat_content(F.col("envelope")).alias("content"),
                          X.chat_usage(F.col("envelope"), "total_tokens").alias("total_tokens"))


@query
def array_rows(spark, sf_dir):
    docs = A.table(spark, sf_dir, "documents").select("doc_id", "lang", F.split("text", "\n").alias("songs"))
    return extract.rows_from_array(docs, "songs", "song")


@query
def zip_rows(spark, sf_dir):
    """Parallel arrays of unequal length: all lines, and the lengths of all but the first."""
    lines = F.split("text", "\n")
    lengths = F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), F.length)
    docs = A.table(spark, sf_dir, "documents").select("doc_id", lines.alias("names"), lengths.alias("lengths"))
    return extract.rows_from_parallel_arrays(docs, {"names": "name", "lengths": "length"})


@query
def union_sparse(spark, sf_dir):
    albums = A.frame(spark, sf_dir, "albums").select("lp_id", "title", "country")
    labels = A.table(spark, sf_dir, "supplier").selectExpr("'LP' || s_suppkey AS lp_id", "s_name AS label_company")
    return extract.union_sparse([albums, labels])


# --- Albums, covers, positions ----------------------------------------------------------------


@query
def album_manifest(spark, sf_dir):
    found = _covers(spark, sf_dir)
    return found.groupBy("lp_id").agg(F.count(F.lit(1)).alias("files"), F.max("depth").cast("bigint").alias("depth"))


@query
def cover_pairs(spark, sf_dir):
    return covers.cover_pairs(_covers(spark, sf_dir))


@query
def complete_albums(spark, sf_dir):
    return covers.complete_pairs(covers.cover_pairs(_covers(spark, sf_dir)))


@query
def cover_folders(spark, sf_dir):
    """Covers in real folders, listed: a cover without a byte is a cover, one that lies too deep is not."""
    path = new_shared_path(spark, "albums")
    named = A.table(spark, sf_dir, "supplier").selectExpr("'LP' || s_suppkey AS lp", "s_suppkey", "s_name").selectExpr(
        "inline(array(struct(lp || '/' || lp || '_cover01.jpg' AS name, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END AS body), "
        "struct(lp || CASE WHEN s_suppkey % 5 = 0 THEN '/in ner/' ELSE '/' END || lp || '_cover02.jpg' AS name, s_name AS body)))")
    sinks.export_files(named, path, "name", "body")
    pairs = covers.cover_pairs(manifest.manifest(manifest.scan_files(spark, path, "*.jpg"), path))
    return pairs.select("lp_id", *[F.element_at(F.split(c, "/"), -1).alias(c) for c in ("front_path", "back_path")])


@query
def natural_sort_first(spark, sf_dir):
    return select.select_positions(_albums(spark, sf_dir), "first-100")


@query
def natural_sort_last(spark, sf_dir):
    return select.select_positions(_albums(spark, sf_dir), "last-50")


@query
def natural_sort_range(spark, sf_dir):
    return select.select_positions(_albums(spark, sf_dir), "21-156")


@query
def natural_positions(spark, sf_dir):
    """Position of every album in natural order."""
    return select.with_position(_albums(spark, sf_dir))


@query
def resume_todo(spark, sf_dir):
    inputs = A.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return match.not_done(inputs, A.table(spark, sf_dir, "labels"), ["doc_id"])


# --- Audio ------------------------------------------------------------------------------------


@query
def audio_exact(spark, sf_dir):
    found = match.match_exact(_tracks(spark, sf_dir), _audio(spark, sf_dir))
    return found.select("LP_ID", "Face", "track_name", "track_no", F.col("Track Filename").alias("file_name"),
                        F.col("Track Length").alias("duration"))


@query
def audio_fallback(spark, sf_dir):
    return match.match_with_fallback(_tracks(spark, sf_dir), _audio(spark, sf_dir))


@query
def slot_grid(spark, sf_dir):
    return match.slot_grid(_audio(spark, sf_dir), _albums(spark, sf_dir))


@query
def album_tracks_nested(spark, sf_dir):
    nested = match.nested_slots(_audio(spark, sf_dir))
    return nested.select("cote", F.size("slots").alias("n_slots"), F.inline("slots"))


@query
def support_count(spark, sf_dir):
    tracks = A.frame(spark, sf_dir, "tracks").select("lp_id")
    return match.with_support_count(A.frame(spark, sf_dir, "albums").select("lp_id"), tracks, "lp_id")


@query
def duration_text(spark, sf_dir):
    return A.frame(spark, sf_dir, "audio_files").select(
        "file_name", S.duration_text(F.col("seconds")).alias("duration"))


@query
def normalise_number(spark, sf_dir):
    return A.frame(spark, sf_dir, "tracks").select(
        "lp_id", "raw_number", S.track_number(F.col("raw_number")).alias("track_no"))


@query
def file_names(spark, sf_dir):
    """What audio file names say: album, slot in both styles, shelfmark."""
    lp, name = F.col("lp_id"), F.col("file_name")
    coded = A.frame(spark, sf_dir, "audio_files").select(
        lp, name, S.slot_code(name).alias("code"), S.legacy_slot_code(lp, name).alias("old_code"))
    code, old_code = F.col("code"), F.col("old_code")
    return coded.select(
        S.lp_id_of_file(name).alias("lp_id"), name, S.code_face(code).alias("face"),
        S.code_number(code).try_cast("int").alias("plage"), S.code_face(old_code).alias("old_face"),
        S.zero_pad(S.code_number(old_code)).alias("old_number"), S.shelfmark(lp).alias("cote"),
        S.shelfmark_of_folder(F.concat(lp, F.lit("_1z1"))).alias("folder_cote"),
        S.output_name(F.concat(lp, F.lit("_combined.txt"))).alias("output_name"))


# --- Labels, texts, payloads ------------------------------------------------------------------


@query
def continent(spark, sf_dir):
    albums = label.with_continent(A.frame(spark, sf_dir, "albums").select("lp_id", "country"), "country")
    return albums.select("lp_id", "continent", "sub_continent", S.capitalise(F.col("country")).alias("pays"))


@query
def continent_table(spark, sf_dir):
    """The lookup against a table of countries: nations by name, for suppliers and customers."""
    nations = A.table(spark, sf_dir, "nation")
    regions = A.table(spark, sf_dir, "region")
    names = nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"]).select(
        F.col("n_nationkey").alias("country"), F.col("r_name").alias("continent"), F.col("n_name").alias("sub_continent"))
    customers = A.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("country"))
    return label.with_continent(customers, "country", names)


@query
def block_text(spark, sf_dir):
    return A.text_blocks(spark, sf_dir).select(
        "doc_id", S.strip(X.blocks_in_reading_order(F.col("blocks"))).alias("text"))


@query
def loose_blocks(spark, sf_dir):
    """Blocks as loose rows, a third of them of one image, in reading order."""
    return covers.texts_of_blocks(A.loose_blocks(spark, sf_dir))


@query
def cover_text(spark, sf_dir):
    """Two sections, of which the second may be unread."""
    back = F.when(F.col("lang") != "en", F.col("source"))
    return A.table(spark, sf_dir, "documents").select("doc_id", X.cover_text(F.col("text"), back).alias("combined_text"))


@query
def prompt_render(spark, sf_dir):
    return A.table(spark, sf_dir, "documents").select("doc_id", S.render_prompt(TEMPLATE, F.col("text")).alias("prompt"))


@query
def image_payload(spark, sf_dir):
    return A.table(spark, sf_dir, "documents").select(
        "doc_id", S.data_url(F.encode("text", "UTF-8")).alias("payload"))


# --- CSV --------------------------------------------------------------------------------------


@query
def csv_null_spellings(spark, sf_dir):
    """To CSV and back: quotes, commas and line ends survive, spellings of "no value" do not."""
    path = new_shared_path(spark, "notes")
    sinks.write_csv(A.frame(spark, sf_dir, "sparse_notes"), path)
    back = files.read_csv(spark, path, strings(["lp_id", "title", "notes"]))
    return back.select("lp_id", "title", "notes",
                       S.name_and_composer(F.col("lp_id"), F.col("notes")).alias("combined"),
                       S.name_and_composer(F.col("lp_id"), F.col("notes"), parity=True).alias("combined_parity"))


@query
def csv_in_parts(spark, sf_dir):
    """The same from one file, read by many tasks."""
    path = new_shared_path(spark, "one-file")
    sinks.write_csv(A.frame(spark, sf_dir, "sparse_notes").coalesce(1), path)
    return csv_parts.read_csv_in_parts(spark, path, strings(["lp_id", "title", "notes"]), part=1 << 14)


@query
def csv_tracks(spark, sf_dir):
    """Raw track rows through CSV."""
    path = new_shared_path(spark, "raw-tracks")
    raw = C.raw_tracks(_track_responses(spark, sf_dir)).drop("seq", "track_no")
    sinks.write_csv(raw, path)
    return files.read_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in raw.columns])).select(
        "LP_ID", "Face", F.col("Track Number").alias("number"), "Track_Name", "Track_Composer", "Track_Length")


@query
def csv_reordered(spark, sf_dir):
    """A CSV table is read by the names in its header: other order, a column more, a column less."""
    path = new_shared_path(spark, "reordered")
    sinks.write_csv(A.frame(spark, sf_dir, "albums").select("publisher", "title", "lp_id"), path)
    return files.read_csv(spark, path, strings(["lp_id", "title", "notes"]))


@query
def catalogue_in_order(spark, sf_dir):
    """Tracks through CSV in catalogue order; the place of each among its album's lines is kept."""
    path = new_shared_path(spark, "ordered")
    lineitem = A.table(spark, sf_dir, "lineitem")
    parts = max(spark.sparkContext.defaultParallelism, lineitem.count() // ROWS_PER_TASK + 1)
    tracks = lineitem.selectExpr(
        "'LP' || l_partkey AS LP_ID", "l_orderkey * 10 + l_linenumber AS seq", "l_orderkey || '-' || l_linenumber AS name")
    sinks.write_csv(C.in_order(tracks, parts).select("LP_ID", "name"), path)
    # Lines of a file are numbered in order. Files are known by the task that wrote them and their number in it, not
    # by name: a path in every row is most of what the window would hold.
    task, nth = (F.regexp_extract(F.input_file_name(), f, 1).cast("int") for f in ("/part-([0-9]+)-[^/]*$", "-c([0-9]+)[^/-]*$"))
    lines = files.read_csv(spark, path, strings(["LP_ID", "name"])).select(
        "*", F.struct(task, nth).alias("file"), F.monotonically_increasing_id().alias("line")).repartition(parts, "LP_ID")
    place = F.row_number().over(W.partitionBy("LP_ID").orderBy("file", "line"))
    return lines.select("LP_ID", "name", place.cast("bigint").alias("place"))


# --- Files ------------------------------------------------------------------------------------


@query
def text_files(spark, sf_dir):
    """One text file per document, and some without a byte, and back."""
    path = new_shared_path(spark, "texts")
    named = A.table(spark, sf_dir, "documents").selectExpr(
        "'LP' || doc_id || '_combined.txt' AS file", "text").unionByName(
        A.table(spark, sf_dir, "supplier").selectExpr("'LP0_' || s_suppkey || '_combined.txt' AS file", "'' AS text"))
    sinks.export_files(named, path, "file", "text")
    return files.read_texts(spark, path)


@query
def document_files(spark, sf_dir):
    """One JSON file per supplier and back, with every reason a document can be unusable for."""
    path = new_shared_path(spark, "documents")
    named = A.table(spark, sf_dir, "supplier").selectExpr(
        "'LP' || s_suppkey || '_ai_output.json' AS file", f"{A.SUPPLIER_DOCUMENT} AS body")
    sinks.export_files(named, path, "file", "body")
    parsed = files.read_documents(spark, path)
    return extract.quarantine(parsed).select("lp_id", "file_name", "reason")


@query
def audio_scan(spark, sf_dir):
    """Audio files of an album folder, found by listing; a cover and a deeper file are left out."""
    path = new_shared_path(spark, "archive")
    names = A.table(spark, sf_dir, "supplier").selectExpr(
        "CASE WHEN s_suppkey % 7 = 0 THEN 'LP1_cover' || s_suppkey || '.jpg' ELSE 'LP1_1z1_A' || s_suppkey || '.mp3' END AS file", "s_name AS body")
    sinks.export_files(names, f"{path}/LP1", "file", "body")
    sinks.export_files(names, f"{path}/LP1/more", "file", "body")
    found = manifest.manifest(manifest.scan_files(spark, path), path)
    return manifest.audio_files(found).select("lp_id", "file_name", F.col("length").cast("bigint").alias("bytes"))


@query
def extra_members(spark, sf_dir):
    """Members without a column of their own, one row each."""
    docs = A.table(spark, sf_dir, "supplier").selectExpr("'LP' || s_suppkey AS lp_id", f"{A.SUPPLIER_DOCUMENT} AS response")
    rows = extract.general_rows(extract.parse_documents(docs, how="whole"), extra="others")
    return rows.select("LP_ID", "Title", F.explode("others").alias("member", "value"))


@query
def resume_by_file(spark, sf_dir):
    """Documents whose file has no output yet; another file of the same album doesn't count."""
    responses = A.frame(spark, sf_dir, "track_responses").select("file_name")
    done = A.table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(
        F.expr(A.INPUTS["track_responses"][1]["file_name"]).alias("file_name"))
    return match.not_done(responses, done, ["file_name"])


@query
def resume_laid_out(spark, sf_dir):
    """Documents without a label, where finished work is laid out by its key and grows by a second write."""
    path = new_shared_path(spark, "finished")
    done = A.table(spark, sf_dir, "labels").select("doc_id", "quality")
    layout.write_laid_out(done.where("doc_id % 2 = 0"), path, ["doc_id"], 8)
    layout.write_laid_out(done.where("doc_id % 2 <> 0"), path, ["doc_id"], 8, append=True)
    inputs = A.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return match.not_done(inputs, layout.read_laid_out(spark, path), ["doc_id"], unique=True)


@query
def audio_laid_out(spark, sf_dir):
    """Seconds of the files that tracks should have, from an inventory that is laid out by album and file."""
    path = new_shared_path(spark, "inventory")
    layout.write_laid_out(_audio(spark, sf_dir), path, ["lp_id", "file_name"], 8)
    wanted = match.with_audio_name(_tracks(spark, sf_dir)).groupBy(
        F.col("LP_ID").alias("lp_id"), F.col("Track Filename").alias("file_name")).agg(F.count(F.lit(1)).alias("tracks"))
    found = match.lookup(wanted, layout.read_laid_out(spark, path), ["lp_id", "file_name"], unique=True)
    return found.select("lp_id", "file_name", "tracks", S.duration_text(F.col("seconds")).alias("duration"))


# --- Checks, calls, arrival -------------------------------------------------------------------


@query
def contract_report(spark, sf_dir):
    return checks.contract_report(C.raw_albums(_general_responses(spark, sf_dir)),
                                  C.raw_tracks(_track_responses(spark, sf_dir)))


@query
def contract_violations(spark, sf_dir):
    """The rows that break a rule, with what breaks it."""
    return checks.violations(C.raw_albums(_general_responses(spark, sf_dir)), C.raw_tracks(_track_responses(spark, sf_dir)))


@query
def track_gaps(spark, sf_dir):
    """Track numbers that an album side lacks below its highest."""
    return checks.track_gaps(_tracks(spark, sf_dir))


@query
def track_runs(spark, sf_dir):
    """Consecutive track numbers of every album side."""
    return checks.track_runs(_tracks(spark, sf_dir))


# The functions that stand for a model, for recognition and for an audio header are local, so they
# travel to the workers by value.


@query
def enrich_text(spark, sf_dir):
    """A model that answers with a digest of the whole prompt and refuses odd lengths."""
    def make_model():
        def answer(prompt: str) -> str:
            if len(prompt) % 2:
                raise ValueError("refused")
            return hashlib.md5(prompt.encode()).hexdigest()

        return answer

    texts = A.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("combined_text"))
    return C.infer(texts, TEMPLATE, make_model).select("doc_id", "response", "response_error")


@query
def enrich_capped(spark, sf_dir):
    """Calls of four workers under a shared quota."""
    def make_model():
        return str.upper

    names = A.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return enrich(names, make_model, {"called": "s_name"}, workers=4, calls_per_minute=60_000)


@query
def calls_in_flight(spark, sf_dir):
    """Several calls at a time over documents; then a second run, whose model fails, takes what is in the ledger."""
    def make_model():
        def answer(prompt: str) -> str:
            if len(prompt) % 2:
                raise ValueError("refused")
            return hashlib.md5(prompt.encode()).hexdigest()

        return answer

    def make_other():
        def answer(prompt: str) -> str:
            raise ValueError("asked again")

        return answer

    ledger, path = new_shared_path(spark, "ledger"), new_shared_path(spark, "answers")
    texts = A.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("combined_text"))
    calling = {"workers": spark.sparkContext.defaultParallelism, "in_flight": 8, "timeout": 60, "ledger": ledger}
    sinks.write_table(C.infer(texts, TEMPLATE, make_model, **calling), path)
    again = C.infer(texts, TEMPLATE, make_other, **calling).select("doc_id", F.col("response").alias("kept"), F.col("response_error").alias("error"))
    return again.join(spark.read.parquet(path).select("doc_id", "response"), "doc_id")


@query
def recognise_covers(spark, sf_dir):
    """Recognition that reads the name of the file, and fails on some."""
    def make_reader():
        def read(path: str) -> str:
            if path.endswith("0_cover01.jpg"):
                raise OSError("unreadable")
            return path.rsplit("/", 1)[-1]

        return read

    pairs = covers.complete_pairs(covers.cover_pairs(_covers(spark, sf_dir)))
    return C.recognise(pairs, make_reader).select("lp_id", "combined_text", "front_text_error")


@query
def enrich_audio(spark, sf_dir):
    """Seconds from a header; files that say 50 have none."""
    def make_reader():
        def seconds(quantity: float) -> float:
            if quantity >= 50:
                raise ValueError("no audio header")
            return quantity * 2

        return seconds

    measured = enrich(A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"),
                      make_reader, {"seconds": "l_quantity"}, T.DoubleType())
    return measured.select("l_orderkey", "l_linenumber", S.duration_text(F.col("seconds")).alias("duration"))


@query
def incremental_arrival(spark, sf_dir):
    """Responses arrive in two parts; each run reads only what is new, a third finds nothing."""
    inbox, output, checkpoint = (new_shared_path(spark, n) for n in ("inbox", "arrived", "arrival-state"))
    responses = A.table(spark, sf_dir, "lineitem")
    source, columns = A.INPUTS["track_responses"]
    first = F.col("l_returnflag") == "N"

    def run() -> None:
        arriving = arrival.arriving_table(spark, inbox, strings(["file_name", "response"]))
        arrival.process_new(arriving, lambda df: C.raw_tracks(C.keyed(df)), output, checkpoint)

    for part in (first, ~first):
        rows = responses.where(part).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
        sinks.append_table(rows, inbox)
        run()
    run()
    return spark.read.parquet(output).groupBy("LP_ID", "Face").agg(
        F.count(F.lit(1)).alias("n"), F.count("track_no").alias("numbered"))


@query
def arrival_split(spark, sf_dir):
    """Responses arrive in two parts; usable ones go to one table, the others to a quarantine, and the last part's
    batch, whose end is forgotten, is processed again."""
    inbox, good, bad, checkpoint = (new_shared_path(spark, n) for n in ("inbox", "good", "bad", "split-state"))
    columns = A.INPUTS["track_responses"][1]
    first = F.col("l_returnflag") == "N"

    def run() -> None:
        arriving = arrival.arriving_table(spark, inbox, strings(["file_name", "response"]))
        arrival.process_split(C.keyed(arriving), extract.track_rows, good, bad, checkpoint, per_task=DOCUMENTS_PER_TASK, keep_text=False)

    for part in (first, ~first):
        rows = A.table(spark, sf_dir, "lineitem").where(part).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
        sinks.append_table(rows, inbox)
        run()
    for place in matching(spark, f"{checkpoint}/commits/1") + matching(spark, f"{checkpoint}/commits/.1.crc"):
        remove(spark, place)
    run()
    kept = spark.read.parquet(good).groupBy(F.lit("ok").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return kept.unionByName(spark.read.parquet(bad).groupBy(F.col("reason").alias("status")).agg(F.count(F.lit(1)).alias("n")))
