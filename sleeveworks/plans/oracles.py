"""The expected result of every query, in SQL for another engine over the same tables.

The inputs are the sub-selects of ``adapters``; the operators are written out independently.
"""

from sleeveworks.plans import adapters as A
from sleeveworks.plans.queries import AS_OF, CURATOR, NOTE, TEMPLATE
from sleeveworks.schema import CONTINENTS, GENERAL_CATALOGUE, NA_SPELLINGS


def _text(value: str) -> str:
    """A string literal; line ends are spelled as chr(10)."""
    return " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in value.split("\n"))


def _padded(raw: str) -> str:
    digits = f"nullif(regexp_extract({raw}, '[0-9]+'), '')"
    return f"CASE WHEN length({digits}) < 2 THEN '0' || {digits} ELSE {digits} END"


def _duration(seconds: str) -> str:
    whole = f"CAST(floor({seconds}) AS BIGINT)"
    return f"coalesce(CAST({whole} // 60 AS VARCHAR) || '''' || right('0' || CAST({whole} % 60 AS VARCHAR), 2), 'missing')"


def _capitalised(text: str) -> str:
    return f"upper(left({text}, 1)) || lower(substr({text}, 2))"


def _place(country: str, i: int) -> str:
    cases = " ".join(f"WHEN {_text(name)} THEN {_text(pair[i])}" for name, pair in CONTINENTS.items())
    return f"CASE {country} {cases} END"


_AUDIO = f"(SELECT lp_id, file_name, min(seconds) AS seconds FROM {A.sql('audio_files')} GROUP BY lp_id, file_name)"
_TRACKS = f"(SELECT lp_id, face, track_name, {_padded('raw_number')} AS track_no FROM {A.sql('tracks')})"

_SIDE_NUMBERS = f"(SELECT DISTINCT lp_id, face, CAST(track_no AS INTEGER) AS n FROM {_TRACKS} WHERE CAST(track_no AS INTEGER) >= 1)"

# Track entries of the responses that hold exactly one object, straight from the table.
_ENTRIES = f"""(
  SELECT lp_id, 0 AS seq, face, CASE WHEN flag = 'A' THEN line ELSE raw_number END AS number, flag = 'A' AS bare,
         track_name, CASE WHEN flag = 'A' THEN 'missing' ELSE composer END AS composer, '3:09' AS length
  FROM rows
  UNION ALL
  SELECT lp_id, 1, CASE face WHEN 'A' THEN 'B' ELSE 'A' END, line || '.a', FALSE, NULL, composer, NULL
  FROM rows WHERE flag = 'R'
)"""
_WITH_ROWS = f"""WITH rows AS (
  SELECT t.*, l_returnflag AS flag, CAST(l_linenumber AS VARCHAR) AS line
  FROM (SELECT {', '.join(f'{e} AS {c}' for c, e in A.INPUTS['tracks'][1].items())}, l_returnflag, l_linenumber, l_suppkey
        FROM lineitem) t
  WHERE l_suppkey % 8 < 6
)"""

# Album entries of the responses, likewise.
_COUNTRY = A.INPUTS["albums"][1]["country"]
_LABEL_NUMBER = "CASE p_size % 3 WHEN 0 THEN 'AB' WHEN 1 THEN 'ABC ' ELSE '' END || p_partkey"
_GENERAL = f"""(
  SELECT 'LP' || p_partkey AS lp_id, {_COUNTRY} AS country, p_name AS title,
         CASE WHEN p_size % 2 = 0 THEN 'Size ' || p_size END AS subtitle, p_brand AS performer,
         p_type AS publisher, CAST(1950 + p_size AS VARCHAR) AS publishing_year,
         p_type || ' Records' AS label_company, {_LABEL_NUMBER} AS label_number, p_name || ' notes' AS notes
  FROM part WHERE p_partkey % 8 < 6 AND p_partkey % 19 <> 0
)"""
_COUNTS = f"(SELECT lp_id, count(*) AS n FROM {A.sql('tracks')} GROUP BY lp_id)"


def _named(values: dict[str, str], columns: list[str]) -> str:
    return ", ".join(f'{values.get(c, "CAST(NULL AS VARCHAR)")} AS "{c}"' for c in columns)


def _catalogue_of_tracks(parity: bool) -> str:
    number = _padded("number")
    if parity:
        number = f"coalesce(CASE WHEN NOT bare THEN {number} END, 'None')"
        combined = "coalesce(track_name, 'nan') || '-' || coalesce(composer, 'nan')"
    else:
        combined = "coalesce(track_name || '-', '') || composer"
    return f"""{_WITH_ROWS}, named AS (
      SELECT *, lp_id || '_1z1_' || face || ({number}) || '.mp3' AS file_name FROM {_ENTRIES}
    )
    SELECT n.lp_id AS "Cote", n.file_name AS "FileName_TBD", face AS "Face", number AS "Plage",
           track_name AS "Titre", {_duration('a.seconds')} AS "Durée", composer AS ai_info_track_composer,
           {combined} AS "ai_Plage_combined"
    FROM named n LEFT JOIN {_AUDIO} a ON n.lp_id = a.lp_id AND n.file_name = a.file_name"""


def _general_catalogue() -> str:
    values = {
        "Côte générale": "g.lp_id", "Support": "'Disque 33 tours'", "Format": "'Format 30 cm'",
        "Continent": _place("country", 0), "Sub-continent": _place("country", 1), "Pays": _capitalised("country"),
        "Titre": "title", "Sous-Titre": "subtitle", "Interprète": "performer", "Production": "publisher",
        "Année de production": "publishing_year", "Numéro édition": "label_number", "Langue": "'Spanish'",
        "Commentaire": _text(f"{NOTE} ({CURATOR} {AS_OF:%m.%Y})"), "date création fiche": f"'{AS_OF:%d.%m.%Y}'",
        "parrain": _text(CURATOR), "Nombre de support": "CAST(greatest(coalesce(n, 0), 1) AS BIGINT)",
        "Edition": "label_company", "cote": "g.lp_id || '-1/1'", "copyrights": "CAST(0 AS BIGINT)",
        "exclure de la consultation": "CAST(0 AS BIGINT)", "ai_info_1_notes": "notes",
    }
    return f"SELECT {_named(values, GENERAL_CATALOGUE)} FROM {_GENERAL} g LEFT JOIN {_COUNTS} c ON g.lp_id = c.lp_id"


_GENERAL_RAW = f"""SELECT lp_id AS "LP_ID", country AS "Country", title AS "Title", subtitle AS "Subtitle",
  performer AS "Performer", publisher AS "Publisher", publishing_year AS "Publishing Year",
  label_company AS "Label Company", label_number AS "Label Number", 'Spanish' AS "Language",
  CAST(NULL AS VARCHAR) AS "Recording Info", 'Folk' AS "Genre/Style", notes AS "Notes",
  CAST(NULL AS VARCHAR) AS "Other Information" FROM {_GENERAL}"""

_RESPONSES = A.sql("track_responses")
_SPAN = "nullif(regexp_extract(response, '(?s)\\{.*\\}'), '')"
_FENCE = "nullif(regexp_extract(response, '(?s)```json\\s*(\\{.*?\\})\\s*```', 1), '')"
_BODY = (
    "CASE WHEN response LIKE '%```json%```%' THEN "
    "trim(regexp_extract(response, '(?s)```json(.*?)```', 1), ' ' || chr(9) || chr(10) || chr(13)) END"
)
_NATURAL = "CAST(regexp_extract(lp_id, '[0-9]+') AS BIGINT)"
_ALBUMS = f"(SELECT DISTINCT lp_id FROM {A.sql('albums')})"

# Cover files, with the album folder and what lies below it.
_FILES = f"""(
  SELECT path, regexp_extract(path, '^/lp/(LP[^/]*)/', 1) AS lp_id, len(string_split(path, '/')) - 3 AS depth
  FROM {A.cover_files_sql()} WHERE path LIKE '/lp/LP%'
)"""
_PAIRS = f"""(
  SELECT lp_id, min(path) FILTER (depth = 1 AND path LIKE '%\\_cover01.jpg' ESCAPE '\\') AS front_path,
         min(path) FILTER (depth = 1 AND path LIKE '%\\_cover02.jpg' ESCAPE '\\') AS back_path
  FROM {_FILES} GROUP BY lp_id
)"""

# Slots that audio file names stand for.
_SLOTS = f"""(
  SELECT lp_id, regexp_extract(file_name, '_([^_])[0-9]+\\.mp3$', 1) AS face,
         CAST(regexp_extract(file_name, '([0-9]+)\\.mp3$', 1) AS INTEGER) AS plage, file_name, seconds
  FROM {_AUDIO}
)"""
_FIRST_OF_SLOT = f"""(
  SELECT lp_id, face, plage, min(file_name) AS file_name, arg_min({_duration('seconds')}, file_name) AS duration
  FROM {_SLOTS} GROUP BY lp_id, face, plage
)"""


def _grid(albums: str) -> str:
    return f"""SELECT g.lp_id, g.face, g.plage, s.file_name, s.duration
      FROM (SELECT lp_id, face, plage FROM {albums}, (VALUES ('A'), ('B')) f(face),
            (SELECT CAST(unnest(generate_series(1, 6)) AS INTEGER) AS plage) p) g
      LEFT JOIN {_FIRST_OF_SLOT} s ON g.lp_id = s.lp_id AND g.face = s.face AND g.plage = s.plage"""


_LINES = """(SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)"""

_AUDIO_EXACT = f"""SELECT t.lp_id AS "LP_ID", t.face AS "Face", t.track_name, t.track_no,
    t.lp_id || '_1z1_' || t.face || t.track_no || '.mp3' AS file_name, {_duration('a.seconds')} AS duration
  FROM {_TRACKS} t LEFT JOIN {_AUDIO} a
    ON a.lp_id = t.lp_id AND a.file_name = t.lp_id || '_1z1_' || t.face || t.track_no || '.mp3'"""

_OLD_FACE = "nullif(regexp_extract(file_name, '^LP[0-9]+_([AB])[0-9]+\\.mp3', 1), '')"
_OLD_NUMBER = _padded("nullif(regexp_extract(file_name, '^LP[0-9]+_[AB]([0-9]+)\\.mp3', 1), '')")
_AUDIO_FALLBACK = f"""WITH exact AS (
    SELECT lp_id, {_OLD_FACE} AS face, {_OLD_NUMBER} AS track_no, min(file_name) AS file_name,
           arg_min({_duration('seconds')}, file_name) AS duration
    FROM {_AUDIO} WHERE {_OLD_FACE} IS NOT NULL GROUP BY ALL
  ), fallback AS (
    SELECT lp_id, min(file_name) AS file_name, arg_min({_duration('seconds')}, file_name) AS duration
    FROM {_AUDIO} GROUP BY lp_id
  )
  SELECT t.lp_id AS "LP_ID", t.face AS "Face", t.track_name, t.track_no,
         coalesce(e.file_name, f.file_name, 'missing') AS "File_Name",
         coalesce(e.duration, f.duration, 'missing') AS "Track_Length"
  FROM {_TRACKS} t
  LEFT JOIN exact e ON t.lp_id = e.lp_id AND t.face = e.face AND t.track_no = e.track_no
  LEFT JOIN fallback f ON t.lp_id = f.lp_id"""

_NA = ", ".join(_text(s) for s in NA_SPELLINGS)
_NOTES = f"(SELECT lp_id, title, CASE WHEN notes NOT IN ({_NA}) THEN notes END AS notes FROM {A.sql('sparse_notes')})"

ORACLES: dict[str, str] = {
    "track_catalogue": _catalogue_of_tracks(parity=False),
    "track_catalogue_parity": _catalogue_of_tracks(parity=True),
    "general_catalogue": _general_catalogue(),
    "raw_general": _GENERAL_RAW,
    "extract_greedy": f"SELECT file_name, {_SPAN} AS span FROM {_RESPONSES}",
    "extract_fenced": f"SELECT file_name, {_FENCE} AS span FROM {_RESPONSES}",
    "extract_strip": f"""SELECT file_name, {_BODY} AS body,
        replace(replace(response, '```json', ''), '```', '') AS unfenced FROM {_RESPONSES}""",
    "quarantine_counts": """SELECT reason, count(*) AS n FROM (
          SELECT 'invalid_json' AS reason FROM lineitem WHERE l_suppkey % 8 >= 6
          UNION ALL SELECT 'invalid_json' FROM part WHERE p_partkey % 8 >= 6
          UNION ALL SELECT 'no_json' FROM conversations WHERE NOT regexp_matches(text, '(?s)\\{.*\\}')
        ) GROUP BY reason""",
    "default_if_absent": f"""{_WITH_ROWS} SELECT lp_id AS "LP_ID", seq, number, track_name AS "Track_Name",
        composer AS "Track_Composer" FROM {_ENTRIES}""",
    "extraction_store": f"""{_WITH_ROWS} SELECT lp_id AS "LP_ID", seq, face AS "Face", {_padded('number')} AS track_no
        FROM {_ENTRIES}""",
    "chat_content": "SELECT conv_id, turn, text AS content, length(text) AS total_tokens FROM conversations",
    "array_rows": f"SELECT doc_id, lang, line AS song FROM {_LINES}",
    "zip_rows": f"""SELECT doc_id, CAST(pos AS INTEGER) AS pos, line AS name,
        CAST(length(lead(line) OVER (PARTITION BY doc_id ORDER BY pos)) AS INTEGER) AS length FROM {_LINES}""",
    "union_sparse": f"""SELECT lp_id, title, country, CAST(NULL AS VARCHAR) AS label_company FROM {A.sql('albums')}
        UNION ALL SELECT 'LP' || s_suppkey, NULL, NULL, s_name FROM supplier""",
    "album_manifest": f"SELECT lp_id, count(*) AS files, max(depth) AS depth FROM {_FILES} GROUP BY lp_id",
    "cover_pairs": f"SELECT * FROM {_PAIRS}",
    "complete_albums": f"SELECT * FROM {_PAIRS} WHERE front_path IS NOT NULL AND back_path IS NOT NULL",
    "natural_sort_first": f"SELECT lp_id FROM {_ALBUMS} ORDER BY {_NATURAL}, lp_id LIMIT 100",
    "natural_sort_last": f"SELECT lp_id FROM {_ALBUMS} ORDER BY {_NATURAL} DESC, lp_id DESC LIMIT 50",
    "natural_sort_range": f"SELECT lp_id FROM {_ALBUMS} ORDER BY {_NATURAL}, lp_id LIMIT 136 OFFSET 20",
    "natural_positions": f"SELECT lp_id, row_number() OVER (ORDER BY {_NATURAL}, lp_id) AS position FROM {_ALBUMS}",
    "resume_todo": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
    "audio_exact": _AUDIO_EXACT,
    "audio_fallback": _AUDIO_FALLBACK,
    "slot_grid": _grid(f"(SELECT lp_id FROM {_ALBUMS} UNION SELECT lp_id FROM {_AUDIO})"),
    "album_tracks_nested": f"""SELECT lp_id AS cote, CAST(12 AS INTEGER) AS n_slots, face, plage, file_name, duration
        FROM ({_grid(f'(SELECT DISTINCT lp_id FROM {_AUDIO})')})""",
    "support_count": f"""SELECT a.lp_id, greatest(coalesce(n, 0), 1) AS support_count
        FROM {A.sql('albums')} a LEFT JOIN {_COUNTS} c ON a.lp_id = c.lp_id""",
    "duration_text": f"SELECT file_name, {_duration('seconds')} AS duration FROM {A.sql('audio_files')}",
    "normalise_number": f"SELECT lp_id, raw_number, {_padded('raw_number')} AS track_no FROM {A.sql('tracks')}",
    "file_names": f"""SELECT lp_id, file_name, regexp_extract(file_name, '_([^_])[0-9]+\\.mp3$', 1) AS face,
        CAST(regexp_extract(file_name, '([0-9]+)\\.mp3$', 1) AS INTEGER) AS plage, {_OLD_FACE} AS old_face,
        {_OLD_NUMBER} AS old_number, lp_id || '-1/1' AS cote, lp_id || '-1/1' AS folder_cote,
        lp_id || '_ai_output.json' AS output_name FROM {A.sql('audio_files')}""",
    "continent": f"""SELECT lp_id, {_place('country', 0)} AS continent, {_place('country', 1)} AS sub_continent,
        {_capitalised('country')} AS pays FROM {A.sql('albums')}""",
    "continent_table": """SELECT c_custkey, c_nationkey AS country, r_name AS continent, n_name AS sub_continent
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "block_text": f"""SELECT doc_id, trim(string_agg(line, chr(10) ORDER BY pos // 2, pos),
        ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text FROM {_LINES} GROUP BY doc_id""",
    "cover_text": """SELECT doc_id, 'Front Cover:' || chr(10) || text || chr(10) || 'Back Cover:' || chr(10) ||
        CASE WHEN lang <> 'en' THEN source ELSE '' END AS combined_text FROM documents""",
    "prompt_render": f"SELECT doc_id, {_text(TEMPLATE)} || text AS prompt FROM documents",
    "image_payload": "SELECT doc_id, 'data:image/jpeg;base64,' || base64(encode(text)) AS payload FROM documents",
    "csv_null_spellings": f"""SELECT lp_id, title, notes, lp_id || coalesce('-' || notes, '') AS combined,
        lp_id || '-' || coalesce(notes, 'nan') AS combined_parity FROM {_NOTES}""",
    "csv_tracks": f"""{_WITH_ROWS} SELECT lp_id AS "LP_ID", face AS "Face", nullif(number, '') AS number,
        track_name AS "Track_Name", composer AS "Track_Composer", length AS "Track_Length" FROM {_ENTRIES}""",
    "csv_reordered": f"SELECT lp_id, title, CAST(NULL AS VARCHAR) AS notes FROM {A.sql('albums')}",
    "catalogue_in_order": """SELECT 'LP' || l_partkey AS "LP_ID", l_orderkey || '-' || l_linenumber AS name,
        row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) AS place FROM lineitem""",
    "text_files": """SELECT 'LP' || doc_id AS lp_id, 'LP' || doc_id || '_combined.txt' AS file_name, text AS combined_text FROM documents
        UNION ALL SELECT 'LP0', 'LP0_' || s_suppkey || '_combined.txt', '' FROM supplier""",
    "document_files": f"""SELECT * FROM (SELECT 'LP' || s_suppkey AS lp_id, 'LP' || s_suppkey || '_ai_output.json' AS file_name,
        {A.SUPPLIER_REASON} AS reason FROM supplier) WHERE reason IS NOT NULL""",
    "audio_scan": """SELECT 'LP1' AS lp_id, 'LP1_1z1_A' || s_suppkey || '.mp3' AS file_name, strlen(s_name) AS bytes
        FROM supplier WHERE s_suppkey % 7 <> 0""",
    "extra_members": """SELECT 'LP' || s_suppkey AS "LP_ID", s_name AS "Title", unnest(['country', 'Rating']) AS member,
        unnest(['N' || s_nationkey, CAST(s_suppkey % 5 AS VARCHAR)]) AS value FROM supplier WHERE s_suppkey % 9 > 6""",
    "resume_by_file": f"""SELECT file_name FROM {A.sql('track_responses')} WHERE file_name NOT IN
        (SELECT {A.INPUTS['track_responses'][1]['file_name']} FROM lineitem WHERE l_linenumber = 1)""",
    "enrich_capped": "SELECT s_suppkey, s_name, upper(s_name) AS called, CAST(NULL AS VARCHAR) AS called_error FROM supplier",
    "contract_report": f"""{_WITH_ROWS}, entries AS (SELECT * FROM {_ENTRIES}),
        sides AS (SELECT lp_id, face, count(*) AS n FROM entries GROUP BY lp_id, face)
        SELECT 'lp_id_format' AS rule, count(*) AS checked,
               count(*) FILTER (NOT regexp_full_match(lp_id, 'LP[0-9]{{4}}')) AS violations FROM {_GENERAL}
        UNION ALL SELECT 'label_number_format', count(*),
               count(*) FILTER (NOT regexp_full_match(label_number, '[A-Za-z]{{2,3}}[^A-Za-z0-9]*[0-9]+')) FROM {_GENERAL}
        UNION ALL SELECT 'face_known', count(*), count(*) FILTER (face NOT IN ('A', 'B')) FROM entries
        UNION ALL SELECT 'track_number_whole', count(*), count(*) FILTER (NOT regexp_full_match(number, '[0-9]+')) FROM entries
        UNION ALL SELECT 'slot_in_grid', count(*), count(*) FILTER (face NOT IN ('A', 'B') OR
               coalesce(TRY_CAST(regexp_extract(number, '[0-9]+') AS INTEGER), 0) NOT BETWEEN 1 AND 6) FROM entries
        UNION ALL SELECT 'album_id_unique', sum(n)::BIGINT, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT
               FROM (SELECT count(*) AS n FROM {_GENERAL} GROUP BY lp_id)
        UNION ALL SELECT 'tracks_per_face', count(*), count(*) FILTER (n <> 6) FROM sides""",
    "enrich_text": f"""SELECT doc_id, CASE WHEN length(p) % 2 = 0 THEN md5(p) END AS response,
        CASE WHEN length(p) % 2 = 1 THEN 'ValueError: refused' END AS response_error
        FROM (SELECT doc_id, {_text(TEMPLATE)} || text AS p FROM documents)""",
    "recognise_covers": f"""SELECT lp_id, 'Front Cover:' || chr(10) ||
        CASE WHEN bad THEN '' ELSE regexp_extract(front_path, '[^/]*$') END || chr(10) || 'Back Cover:' || chr(10) ||
        regexp_extract(back_path, '[^/]*$') AS combined_text, CASE WHEN bad THEN 'OSError: unreadable' END AS front_text_error
        FROM (SELECT *, front_path LIKE '%0\\_cover01.jpg' ESCAPE '\\' AS bad FROM {_PAIRS})
        WHERE front_path IS NOT NULL AND back_path IS NOT NULL""",
    "enrich_audio": f"""SELECT l_orderkey, l_linenumber, {_duration('CASE WHEN l_quantity < 50 THEN l_quantity * 2 END')} AS duration
        FROM lineitem""",
    "incremental_arrival": f"""{_WITH_ROWS} SELECT lp_id AS "LP_ID", face AS "Face", count(*) AS n,
        count({_padded('number')}) AS numbered FROM {_ENTRIES} GROUP BY lp_id, face""",
    "member_columns": """SELECT 'LP' || s_suppkey AS "LP_ID", s_name AS "Title", s_suppkey % 5 AS "Sleeves",
        CASE WHEN s_suppkey % 2 = 0 THEN 120.0 ELSE 99.5 END::DOUBLE AS "Weight (g)", CASE WHEN s_suppkey % 3 = 0 THEN TRUE END AS "Stereo",
        CASE WHEN s_suppkey % 7 = 0 THEN '78 rpm' ELSE '33' END AS "Speed", CAST(NULL AS VARCHAR) AS "Empty" FROM supplier""",
    "cover_folders": """SELECT 'LP' || s_suppkey AS lp_id, 'LP' || s_suppkey || '_cover01.jpg' AS front_path,
        CASE WHEN s_suppkey % 5 <> 0 THEN 'LP' || s_suppkey || '_cover02.jpg' END AS back_path FROM supplier""",
    "loose_blocks": f"""SELECT image_path, string_agg(line, chr(10) ORDER BY doc_id * 1000000 + pos // 2, pos) AS text
        FROM (SELECT *, {A.LOOSE_IMAGE} AS image_path FROM {_LINES}) GROUP BY image_path""",
    "contract_violations": f"""{_WITH_ROWS}, entries AS (SELECT * FROM {_ENTRIES})
        SELECT lp_id AS "LP_ID", CAST(NULL AS INTEGER) AS seq, 'lp_id_format' AS rule, lp_id AS value FROM {_GENERAL}
               WHERE NOT regexp_full_match(lp_id, 'LP[0-9]{{4}}')
        UNION ALL SELECT lp_id, NULL, 'label_number_format', label_number FROM {_GENERAL}
               WHERE NOT regexp_full_match(label_number, '[A-Za-z]{{2,3}}[^A-Za-z0-9]*[0-9]+')
        UNION ALL SELECT lp_id, seq, 'face_known', face FROM entries WHERE face NOT IN ('A', 'B')
        UNION ALL SELECT lp_id, seq, 'track_number_whole', number FROM entries WHERE NOT regexp_full_match(number, '[0-9]+')
        UNION ALL SELECT lp_id, seq, 'slot_in_grid', number FROM entries WHERE face NOT IN ('A', 'B') OR
               coalesce(TRY_CAST(regexp_extract(number, '[0-9]+') AS INTEGER), 0) NOT BETWEEN 1 AND 6""",
    "track_gaps": f"""SELECT lp_id AS "LP_ID", face AS "Face", before + 1 AS first_missing, n - 1 AS last_missing FROM (
        SELECT *, lag(n, 1, 0) OVER (PARTITION BY lp_id, face ORDER BY n) AS before FROM {_SIDE_NUMBERS}) WHERE n > before + 1""",
    "track_runs": f"""SELECT lp_id AS "LP_ID", face AS "Face", min(n) AS first, max(n) AS last FROM (
        SELECT *, n - row_number() OVER (PARTITION BY lp_id, face ORDER BY n) AS run FROM {_SIDE_NUMBERS}) GROUP BY lp_id, face, run""",
    "calls_in_flight": f"""SELECT doc_id, response, response AS kept, CASE WHEN response IS NULL THEN 'ValueError: asked again' END AS error
        FROM (SELECT doc_id, CASE WHEN length(p) % 2 = 0 THEN md5(p) END AS response
              FROM (SELECT doc_id, {_text(TEMPLATE)} || text AS p FROM documents))""",
    "arrival_split": f"""{_WITH_ROWS} SELECT 'ok' AS status, count(*) AS n FROM {_ENTRIES}
        UNION ALL SELECT 'invalid_json', count(*) FROM lineitem WHERE l_suppkey % 8 >= 6 HAVING count(*) > 0""",
    "csv_in_parts": f"SELECT lp_id, title, notes FROM {_NOTES}",
    "resume_laid_out": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
    "audio_laid_out": f"""SELECT t.lp_id, t.file_name, tracks, {_duration('a.seconds')} AS duration FROM (
        SELECT lp_id, lp_id || '_1z1_' || face || track_no || '.mp3' AS file_name, count(*) AS tracks FROM {_TRACKS} GROUP BY ALL) t
        LEFT JOIN {_AUDIO} a ON a.lp_id = t.lp_id AND a.file_name = t.file_name""",
}
