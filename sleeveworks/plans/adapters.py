"""Catalogue inputs derived from the benchmark tables.

Each input is a list of column expressions over one table, in SQL that means the same in Spark
and in ANSI databases. ``frame`` evaluates it in Spark; ``sql`` prints it as a sub-select, so a
check in another engine starts from the same rows. Every input keeps all rows of its table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeveworks.schema import NA_SPELLINGS

# Album ids of track rows and audio rows: some albums hand theirs to the next album, so that
# albums without tracks and albums without audio exist.
_TRACK_LP = "'LP' || (l_partkey + CASE WHEN l_partkey % 13 = 0 THEN 1 ELSE 0 END)"
_AUDIO_LP = "'LP' || (l_partkey + CASE WHEN l_partkey % 17 = 0 THEN 1 ELSE 0 END)"
_FACE = "CASE WHEN l_linestatus = 'O' THEN 'A' ELSE 'B' END"
_OTHER_FACE = "CASE WHEN l_linestatus = 'O' THEN 'B' ELSE 'A' END"
_RAW_NUMBER = (
    "CASE l_orderkey % 4 WHEN 0 THEN l_linenumber || '.' WHEN 1 THEN '0' || l_linenumber "
    "WHEN 2 THEN 'Nr ' || l_linenumber ELSE '' END"
)
_TRACK_NAME = "'Tune ' || CAST(CAST(l_shipdate AS DATE) AS STRING)"
_COMPOSER = "'Composer ' || l_suppkey"
_COUNTRY = (
    "CASE p_partkey % 11 WHEN 0 THEN 'Spain' WHEN 1 THEN 'Espagne' WHEN 2 THEN 'Uruguay' "
    "WHEN 3 THEN 'URUGUAY' WHEN 4 THEN 'Paraguay' WHEN 5 THEN 'Bolivia' WHEN 6 THEN 'Bolivie' "
    "WHEN 7 THEN 'Mexico' WHEN 8 THEN 'Mexique' WHEN 9 THEN 'costa RICA' END"
)

# Track entry by return flag: N is complete, A has a bare number and no composer key, R brings a
# second entry on the other face whose name is an explicit null.
_FIRST_ENTRY = (
    f"'{{\"Face\":\"' || {_FACE} || '\",\"Track_Number\":' || "
    f"CASE WHEN l_returnflag = 'A' THEN CAST(l_linenumber AS STRING) ELSE '\"' || {_RAW_NUMBER} || '\"' END || "
    f"',\"Track_Name\":\"' || {_TRACK_NAME} || '\"' || "
    f"CASE WHEN l_returnflag = 'A' THEN '' ELSE ',\"Track_Composer\":\"' || {_COMPOSER} || '\"' END || "
    "',\"Track_Length\":\"3:09\"}'"
)
_SECOND_ENTRY = (
    f"CASE WHEN l_returnflag = 'R' THEN ',{{\"Face\":\"' || {_OTHER_FACE} || '\",\"Track_Number\":\"' || "
    f"l_linenumber || '.a\",\"Track_Name\":null,\"Track_Composer\":\"' || {_COMPOSER} || '\"}}' ELSE '' END"
)
TRACK_DOCUMENT = f"'{{\"Track Info\":[' || {_FIRST_ENTRY} || {_SECOND_ENTRY} || ']}}'"


def _wrapped(document: str, key: str) -> str:
    """Bare, fenced, inside prose, followed by a second object, or cut off."""
    before = f"CASE {key} % 8 WHEN 4 THEN '```json' || chr(10) WHEN 5 THEN 'Sure: ' WHEN 7 THEN '{{\"cut\":' ELSE '' END"
    after = f"CASE {key} % 8 WHEN 4 THEN chr(10) || '```' WHEN 5 THEN ' done' WHEN 6 THEN ' and {{\"b\":2}}' ELSE '' END"
    return f"{before} || {document} || {after}"


_SUBTITLE = "CASE WHEN p_size % 2 = 0 THEN '\"Subtitle\":\"Size ' || p_size || '\",' ELSE '' END"
_GENERAL_DOCUMENT = (
    "'{\"General Information\":' || CASE WHEN p_partkey % 19 = 0 THEN '{}' ELSE "
    "'{\"LP_ID\":\"LP0\",\"Country\":' || coalesce('\"' || " + _COUNTRY + " || '\"', 'null') || "
    "',\"Title\":\"' || p_name || '\",' || " + _SUBTITLE + " || "
    "'\"Performer\":\"' || p_brand || '\",\"Publisher\":\"' || p_type || '\",\"Publishing Year\":' || "
    "(1950 + p_size) || ',\"Label Company\":\"' || p_type || ' Records\",\"Label Number\":\"' || "
    "CASE p_size % 3 WHEN 0 THEN 'AB' WHEN 1 THEN 'ABC ' ELSE '' END || p_partkey || '\",\"Language\":\"Spanish\",\"Genre/Style\":\"Folk\",\"Notes\":\"' || p_name || ' notes\"}' END || "
    "',\"Track Info\":[]}'"
)

INPUTS: dict[str, tuple[str, dict[str, str]]] = {
    "albums": ("part", {
        "lp_id": "'LP' || p_partkey",
        "title": "p_name",
        "publisher": "p_brand",
        "label_number": "p_type",
        "country": _COUNTRY,
    }),
    "tracks": ("lineitem", {
        "lp_id": _TRACK_LP,
        "face": _FACE,
        "raw_number": _RAW_NUMBER,
        "track_name": _TRACK_NAME,
        "composer": _COMPOSER,
    }),
    # Two file name styles; a full-quantity line stands for an unreadable file.
    "audio_files": ("lineitem", {
        "lp_id": _AUDIO_LP,
        "file_name": (
            f"{_AUDIO_LP} || CASE WHEN (l_partkey + l_linenumber) % 3 = 0 "
            f"THEN '_' || {_FACE} || l_linenumber ELSE '_1z1_' || {_FACE} || '0' || l_linenumber END || '.mp3'"
        ),
        "seconds": "CASE WHEN l_quantity < 50 THEN floor(l_quantity * 73) / 10 END",
    }),
    "track_responses": ("lineitem", {
        "file_name": f"{_TRACK_LP} || '_' || l_orderkey || '_ai_output.json'",
        "response": _wrapped(TRACK_DOCUMENT, "l_suppkey"),
    }),
    "general_responses": ("part", {
        "file_name": "'LP' || p_partkey || '_ai_output.json'",
        "response": _wrapped(_GENERAL_DOCUMENT, "p_partkey"),
    }),
    # A notes column that goes through the spellings of "no value", and a title hard on CSV.
    "sparse_notes": ("part", {
        "lp_id": "'LP' || p_partkey",
        "title": "'\"' || p_name || '\", ' || chr(10) || ' side 2 '",
        "notes": f"CASE p_partkey % {len(NA_SPELLINGS) + 3} " + " ".join(
            f"WHEN {i} THEN '{s}'" for i, s in enumerate(NA_SPELLINGS)
        ) + " WHEN 19 THEN 'missing' WHEN 20 THEN '0' ELSE p_name END",
    }),
    "chat_answers": ("conversations", {
        "conv_id": "conv_id",
        "turn": "turn",
        "role": "role",
        "text": "text",
    }),
}

# Cover images of one document: a front, for some a second front, a back that for some lies one
# folder too deep, and a folder that is no album.
_COVERS = [
    "'/lp/LP' || doc_id || '/LP' || doc_id || '_cover01.jpg'",
    "CASE WHEN doc_id % 7 = 0 THEN '/lp/LP' || doc_id || '/LP' || doc_id || '_b_cover01.jpg' END",
    "'/lp/LP' || doc_id || CASE WHEN doc_id % 5 = 0 THEN '/inner' ELSE '' END || '/LP' || doc_id || '_cover02.jpg'",
    "'/lp/XX' || doc_id || '/XX_cover01.jpg'",
]


# Documents of every kind the parser tells apart, one per supplier; undeclared members among them.
SUPPLIER_DOCUMENT = (
    "CASE s_suppkey % 9 WHEN 0 THEN '' WHEN 1 THEN '[1]' WHEN 2 THEN '{\"cut\":' WHEN 3 THEN '{}' "
    "WHEN 4 THEN '{\"General Information\":7}' WHEN 5 THEN '{\"Track Info\":{\"a\":1}}' WHEN 6 THEN '{\"Track Info\":[1]}' "
    "ELSE '{\"General Information\":{\"Title\":\"' || s_name || '\",\"country\":\"N' || s_nationkey || '\",\"Rating\":' || (s_suppkey % 5) || '}}' END"
)
SUPPLIER_REASON = (
    "CASE s_suppkey % 9 WHEN 0 THEN 'no_json' WHEN 1 THEN 'not_object' WHEN 2 THEN 'invalid_json' "
    "WHEN 4 THEN 'general_not_object' WHEN 5 THEN 'tracks_not_array' WHEN 6 THEN 'track_not_object' END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table, as it is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str, spread: int | None = None) -> DataFrame:
    """An input. ``spread`` deals the rows out anew before they are worked on: for a small file, which is read by
    one task, with rows that are dear to decode."""
    source, columns = INPUTS[name]
    rows = table(spark, sf_dir, source)
    rows = rows if spread is None else rows.repartition(spread)
    return rows.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def sql(name: str) -> str:
    source, columns = INPUTS[name]
    return f"(SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source})"


def cover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path`` of every cover image."""
    paths = table(spark, sf_dir, "documents").selectExpr(f"array({', '.join(_COVERS)}) AS paths")
    return paths.select(F.explode(F.array_compact("paths")).alias("path"))


def cover_files_sql() -> str:
    return f"(SELECT path FROM (SELECT unnest([{', '.join(_COVERS)}]) AS path FROM documents) WHERE path IS NOT NULL)"


def text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document as the blocks of one image, in scrambled order.

    Two neighbouring lines share a height, so their order of detection decides.
    """
    lines = F.split("text", "\n")
    blocks = F.transform(lines, lambda line, i: F.struct(
        F.xxhash64(line, i).alias("scramble"), (i % 7).alias("x"), F.floor(i / 2).cast("int").alias("y"),
        i.alias("seq"), line.alias("text")))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_sort(blocks).alias("blocks"))


# Blocks of images as loose rows: every third document is a part of one image.
LOOSE_IMAGE = "CASE WHEN doc_id % 3 = 0 THEN 'hot' ELSE 'image ' || doc_id END"


def loose_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per line of every document, in scrambled order; two neighbouring lines share a height."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    rows = lines.selectExpr(f"{LOOSE_IMAGE} AS image_path", "doc_id * 1000000 + pos div 2 AS y", "pos AS seq", "text")
    return rows.repartition(F.xxhash64("text", "seq"))


# A document with members that nobody declared: a whole number, a fraction, a truth value, and one whose types clash.
MEMBERS_DOCUMENT = (
    "'{\"General Information\":{\"Title\":\"' || s_name || '\",\"Sleeves\":' || (s_suppkey % 5) || ',\"Weight (g)\":' || "
    "CASE WHEN s_suppkey % 2 = 0 THEN '120' ELSE '99.5' END || CASE WHEN s_suppkey % 3 = 0 THEN ',\"Stereo\":true' ELSE '' END || "
    "',\"Speed\":' || CASE WHEN s_suppkey % 7 = 0 THEN '\"78 rpm\"' ELSE '33' END || ',\"Empty\":null}}'"
)
