"""Whole runs over small folders, and incremental arrival."""

import datetime as dt
import json
import os
import shutil

import pytest
from pyspark.sql import types as T

from sleeveworks.operators import extract
from sleeveworks.plans import catalogue, queries
from sleeveworks.plans.catalogue import Run
from sleeveworks.schema import CLEAN_GENERAL, CLEAN_TRACK
from sleeveworks.sources import files, manifest
from sleeveworks.streaming import arrival


@pytest.fixture
def archive(tmp_path):
    base = tmp_path / "albums"
    for lp, names in {"LP1": ["cover01.jpg", "cover02.jpg", "1z1_A01.mp3"], "LP2": ["cover01.jpg", "cover02.jpg"],
                      "LP3": ["cover01.jpg"]}.items():
        for name in names:
            (base / lp).mkdir(parents=True, exist_ok=True)
            (base / lp / f"{lp}_{name}").write_text(f"{lp} {name}")
    return tmp_path


def make_reader(log):
    def make():
        def read(path):
            with open(log, "a") as f:
                f.write(path + "\n")
            return open(path.removeprefix("file:")).read()
        return read
    return make


def make_model(log, broken=()):
    def make():
        def answer(prompt):
            lp = prompt.split("Front Cover:\n")[1].split(" ")[0]
            with open(log, "a") as f:
                f.write(lp + "\n")
            if lp in broken:
                return "no idea"
            doc = {"General Information": {"Country": "Spain", "Title": f"Title {lp}"},
                   "Track Info": [{"Face": "A", "Track_Number": "1.", "Track_Name": "Song"}, {"Face": "B", "Track_Number": 2}]}
            return f"```json\n{json.dumps(doc)}\n```"
        return answer
    return make


def lines(path):
    return path.read_text().split("\n")[:-1] if path.exists() else []


def test_run_from_folders_to_catalogues(spark, rows, archive):
    run = Run(spark, str(archive / "albums"), str(archive / "work"), "A. B", "Digitised.", dt.date(2024, 9, 5))
    ocr, model = archive / "ocr.log", archive / "model.log"

    run.recognise_covers(make_reader(str(ocr)), "first-1")
    assert rows(run.table("ocr_text"), "lp_id", "combined_text") == [
        ("LP1", "Front Cover:\nLP1 cover01.jpg\nBack Cover:\nLP1 cover02.jpg")]
    run.recognise_covers(make_reader(str(ocr)))
    assert len(lines(ocr)) == 4 and rows(run.table("ocr_text"), "lp_id") == [("LP1",), ("LP2",)]

    run.ask_model("Extract.\n", make_model(str(model), broken=["LP2"]))
    assert sorted(lines(model)) == ["LP1", "LP2"]
    run.ask_model("Extract.\n", make_model(str(model)))
    assert sorted(lines(model)) == ["LP1", "LP2", "LP2"]
    run.ask_model("Extract.\n", make_model(str(model)))
    assert len(lines(model)) == 3

    audio = manifest.audio_files(run.manifest()).selectExpr("lp_id", "file_name", "185.9D AS seconds")
    run.flatten(audio)
    assert rows(run.table("unreadable"), "lp_id", "reason") == [("LP2", "no_json")]
    run.label()
    tracks = files.read_csv(spark, run.path("track_catalogue"), CLEAN_TRACK)
    assert rows(tracks) == [
        ("LP1", "LP1_1z1_A01.mp3", "A", "1.", "Song", "3'05", "missing", "Song-missing"),
        ("LP1", "LP1_1z1_B02.mp3", "B", "2", "missing", "missing", "missing", "missing-missing"),
        ("LP2", "LP2_1z1_A01.mp3", "A", "1.", "Song", "missing", "missing", "Song-missing"),
        ("LP2", "LP2_1z1_B02.mp3", "B", "2", "missing", "missing", "missing", "missing-missing")]
    albums = files.read_csv(spark, run.path("general_catalogue"), CLEAN_GENERAL)
    assert rows(albums, "cote", "Continent", "Titre", "`Nombre de support`", "Commentaire") == [
        ("LP1-1/1", "Europe", "Title LP1", 2, "Digitised. (A. B 09.2024)"),
        ("LP2-1/1", "Europe", "Title LP2", 2, "Digitised. (A. B 09.2024)")]

    out = archive / "export"
    run.export(str(out))
    assert sorted(p.name for p in (out / "texts").iterdir()) == ["LP1_combined.txt", "LP2_combined.txt"]
    again = Run(spark, run.base_dir, str(archive / "again"), run.curator, run.note, run.as_of)
    (out / "documents" / "LP5_ai_output.json").write_text("{")
    again.load_texts(str(out / "texts"))
    again.load_documents(str(out / "documents"))
    again.load_documents(str(out / "documents"))
    assert rows(again.table("ocr_text"), "lp_id") == [("LP1",), ("LP2",)]
    assert rows(again.table("extractions")) == rows(run.table("extractions"))
    assert ("LP5", "invalid_json") in rows(again.table("unreadable"), "lp_id", "reason")
    again.flatten(audio)
    again.label()
    fresh = rows(files.read_csv(spark, again.path("track_catalogue"), CLEAN_TRACK))
    assert fresh == rows(tracks)
    again.label_csv(str(out))
    assert rows(files.read_csv(spark, again.path("track_catalogue"), CLEAN_TRACK)) == fresh
    assert rows(files.read_csv(spark, again.path("general_catalogue"), CLEAN_GENERAL)) == rows(albums)


def test_contents_and_audio(spark, rows, archive):
    run = Run(spark, str(archive / "albums"), str(archive / "work"), "A. B", "", dt.date(2024, 9, 5))
    run.recognise_covers(lambda: bytes.decode, contents=True)
    assert rows(run.table("ocr_text"), "lp_id", "combined_text")[0] == (
        "LP1", "Front Cover:\nLP1 cover01.jpg\nBack Cover:\nLP1 cover02.jpg")
    run.ask_model("Extract.\n", make_model(str(archive / "model.log")))
    run.measure_audio(lambda: lambda content: len(content) + 100.0)
    run.flatten()
    assert rows(run.table("tracks_with_audio"), "LP_ID", "`Track Length`") == [
        ("LP1", "1'55"), ("LP1", "missing"), ("LP2", "missing"), ("LP2", "missing")]


def test_failed_readings_are_tried_again(spark, rows, archive):
    run = Run(spark, str(archive / "albums"), str(archive / "work"), "A. B", "", dt.date(2024, 9, 5))
    log = archive / "ocr.log"

    def broken():
        read = make_reader(str(log))()

        def one(path):
            if "LP1_cover02" in path:
                raise OSError("outage")
            return read(path)
        return one

    run.recognise_covers(lambda: broken())
    assert rows(run.table("ocr_text"), "lp_id") == [("LP2",)]
    run.recognise_covers(make_reader(str(log)))
    assert rows(run.table("ocr_text"), "lp_id", "combined_text")[0] == (
        "LP1", "Front Cover:\nLP1 cover01.jpg\nBack Cover:\nLP1 cover02.jpg")
    assert len(lines(log)) == 5


def test_paid_answers_survive_a_failing_run(spark, rows, archive):
    """A run that dies between portions keeps what it paid for, and the next one parses it."""
    run = Run(spark, str(archive / "albums"), str(archive / "work"), "A. B", "", dt.date(2024, 9, 5), portion=1)
    names = [f"LP{i}" for i in range(1, 9)]
    (archive / "texts").mkdir()
    for lp in names:
        (archive / "texts" / f"{lp}_combined.txt").write_text(f"Front Cover:\n{lp} x")
    run.load_texts(str(archive / "texts"))
    log, answer, asked = archive / "model.log", make_model(str(archive / "model.log")), []
    real = catalogue.infer

    def dying(rows_, *args, **calling):
        asked.append(1)
        if len(asked) == 5:
            raise RuntimeError("the driver dies")
        return real(rows_, *args, **calling)

    catalogue.infer = dying
    try:
        with pytest.raises(RuntimeError):
            run.ask_model("Extract.\n", answer)
    finally:
        catalogue.infer = real
    paid = lines(log)
    run.ask_model("Extract.\n", answer)
    assert 0 < len(paid) < 8 and sorted(lines(log)) == names
    assert rows(run.table("extractions"), "lp_id") == [(lp,) for lp in names]


def test_answers_of_a_lost_task_are_not_paid_again(spark, rows, archive):
    """A worker dies in the middle of a portion; the next run asks for what has no answer yet, and an answer that turns
    out unusable may be asked for again."""
    run = Run(spark, str(archive / "albums"), str(archive / "work"), "A. B", "", dt.date(2024, 9, 5))
    names = [f"LP{i}" for i in range(1, 9)]
    (archive / "texts").mkdir()
    for lp in names:
        (archive / "texts" / f"{lp}_combined.txt").write_text(f"Front Cover:\n{lp} x")
    run.load_texts(str(archive / "texts"))
    log = archive / "model.log"

    def fragile():
        answer = make_model(str(log), broken=["LP3"])()

        def one(prompt):
            if len(lines(log)) >= 4:
                os._exit(1)
            return answer(prompt)
        return one

    with pytest.raises(Exception):
        run.ask_model("Extract.\n", fragile)
    paid = lines(log)
    run.ask_model("Extract.\n", make_model(str(log), broken=["LP3"]))
    assert len(paid) >= 4 and sorted(lines(log)) == names
    run.ask_model("Extract.\n", make_model(str(log)))
    assert sorted(lines(log)) == sorted([*names, "LP3"])
    assert rows(run.table("extractions"), "lp_id") == [(lp,) for lp in names]


def test_two_texts_of_an_album(spark, rows, archive):
    """Each has a document of its own, and each is paid for once."""
    run = Run(spark, str(archive / "albums"), str(archive / "work"), "A. B", "", dt.date(2024, 9, 5))
    for folder in ("a b#1", "b%20"):
        (archive / "texts" / folder).mkdir(parents=True)
        (archive / "texts" / folder / "LP1_combined.txt").write_text(f"Front Cover:\nLP1 {folder}")
    log = archive / "model.log"
    for _ in range(2):
        run.load_texts(str(archive / "texts"))
        run.ask_model("Extract.\n", make_model(str(log)))
    assert lines(log) == ["LP1", "LP1"]
    assert rows(run.table("extractions"), "lp_id", "file_name") == [("LP1", "a b#1/LP1_ai_output.json"), ("LP1", "b%20/LP1_ai_output.json")]
    run.flatten(spark.createDataFrame([], "lp_id string, file_name string, seconds double"))
    run.export(str(archive / "out dir#"))
    assert (archive / "out dir#" / "texts" / "b%20" / "LP1_combined.txt").read_text() == "Front Cover:\nLP1 b%20"


@pytest.mark.parametrize("name", ["al bums", "al#bums", "al%20bums", "al+é"])
def test_odd_folder_names(spark, rows, tmp_path, name):
    """Blanks, ``#`` and ``%`` in any folder; a cover without a byte is a cover."""
    base = tmp_path / name
    for lp in ("LP1", "LP2 x"):
        (base / lp).mkdir(parents=True)
        (base / lp / f"{lp}_cover01.jpg").write_text("" if lp == "LP1" else "front")
        (base / lp / f"{lp}_cover02.jpg").write_text("back")
        (base / lp / f"{lp}_1z1_A01.mp3").write_text("")
    run = Run(spark, str(base), str(tmp_path / "work"), "A. B", "", dt.date(2024, 9, 5), workers=2, in_flight=3, timeout=20)
    run.recognise_covers(lambda: bytes.decode, contents=True)
    assert rows(run.table("ocr_text"), "lp_id", "combined_text") == [
        ("LP1", "Front Cover:\n\nBack Cover:\nback"), ("LP2 x", "Front Cover:\nfront\nBack Cover:\nback")]
    run.measure_audio(lambda: lambda content: float(len(content)))
    assert rows(run.table("audio"), "lp_id", "seconds") == [("LP1", 0.0), ("LP2 x", 0.0)]


def test_documents_are_known_by_file(spark, rows, archive):
    run = Run(spark, str(archive / "albums"), str(archive / "work"), "A. B", "", dt.date(2024, 9, 5))
    inbox = archive / "in"
    inbox.mkdir()
    (inbox / "LP1_ai_output.json").write_text('{"Track Info": [{"Face": "A"}]}')
    (inbox / "LP9_ai_output.json").write_text("{")
    run.load_documents(str(inbox))
    (inbox / "LP1_side2_ai_output.json").write_text('{"Track Info": [{"Face": "B"}]}')
    for _ in range(2):
        run.load_documents(str(inbox))
    assert rows(run.table("extractions"), "lp_id", "file_name") == [("LP1", "LP1_ai_output.json"), ("LP1", "LP1_side2_ai_output.json")]
    assert rows(run.table("unreadable"), "file_name", "reason") == [("LP9_ai_output.json", "invalid_json")]


def test_equal_names_in_two_folders(spark, rows, archive):
    run = Run(spark, str(archive / "albums"), str(archive / "work"), "A. B", "", dt.date(2024, 9, 5))
    inbox = archive / "in box%20é+"
    for folder, face in [("batch1", "A"), ("batch2", "B"), ("a b%20/é", "C")]:
        (inbox / folder).mkdir(parents=True)
        (inbox / folder / "LP1_ai_output.json").write_text(json.dumps({"Track Info": [{"Face": face}]}))
        (inbox / folder / "LP9_ai_output.json").write_text("" if face == "A" else "{")
    (inbox / "LP1_ai_output.json").write_text('{"Track Info": [{"Face": "D"}]}')
    names = ["LP1_ai_output.json", "a b%20/é/LP1_ai_output.json", "batch1/LP1_ai_output.json", "batch2/LP1_ai_output.json"]
    for directory in (f"file:{inbox}", f"{inbox}/"):
        run.load_documents(directory)
        assert rows(run.table("extractions"), "lp_id", "file_name") == [("LP1", n) for n in names]
        assert rows(run.table("unreadable"), "lp_id", "file_name", "reason") == [
            ("LP9", "a b%20/é/LP9_ai_output.json", "invalid_json"), ("LP9", "batch1/LP9_ai_output.json", "no_json"),
            ("LP9", "batch2/LP9_ai_output.json", "invalid_json")]
    run.load_texts(str(inbox))
    run.flatten(spark.createDataFrame([], "lp_id string, file_name string, seconds double"))
    assert rows(run.table("raw_tracks"), "Face") == [("A",), ("B",), ("C",), ("D",)]
    run.export(str(archive / "out"))
    for n in names:
        assert json.loads((archive / "out" / "documents" / n).read_text()) == json.loads((inbox / n).read_text())
    assert rows(files.read_documents(spark, f"{inbox}/batch1/LP1_ai_output.json"), "lp_id", "file_name") == [("LP1", "LP1_ai_output.json")]


def test_arriving_files_are_processed_once(spark, rows, tmp_path):
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    inbox.mkdir()

    def put(lp, face):
        (inbox / f"{lp}_ai_output.json").write_text(json.dumps({"Track Info": [{"Face": face}]}, indent=1))

    def run():
        arriving = arrival.arriving_files(spark, str(inbox), "*.json", "response")
        arrival.process_new(arriving, lambda df: extract.track_rows(extract.parse_documents(df, how="whole")), out, state)
        return rows(spark.read.parquet(out), "LP_ID", "Face")

    put("LP1", "A")
    assert run() == [("LP1", "A")]
    assert run() == [("LP1", "A")]
    put("LP2", "B")
    assert run() == [("LP1", "A"), ("LP2", "B")]


def test_a_repeated_batch_changes_nothing(spark, rows, tmp_path):
    """Good and bad rows of a stream in two tables; a batch whose commit was lost is processed again."""
    inbox, good, bad, state = tmp_path / "in", str(tmp_path / "good"), str(tmp_path / "bad"), tmp_path / "state"
    inbox.mkdir()

    def put(lp, text):
        (inbox / f"{lp}_ai_output.json").write_text(text)

    def run():
        arriving = arrival.arriving_files(spark, str(inbox), "*.json", "response")
        arrival.process_split(arriving, extract.track_rows, good, bad, str(state), how="whole")
        return rows(spark.read.parquet(good), "LP_ID", "Face"), rows(spark.read.parquet(bad), "lp_id", "reason")

    put("LP1", json.dumps({"Track Info": [{"Face": "A"}, {"Face": "B"}]}))
    put("LP2", "{")
    first = [("LP1", "A"), ("LP1", "B")], [("LP2", "invalid_json")]
    assert run() == first and run() == first
    put("LP3", json.dumps({"Track Info": [{"Face": "C"}]}))
    put("LP4", "[1]")
    second = first[0] + [("LP3", "C")], first[1] + [("LP4", "not_object")]
    assert run() == second
    commits = sorted((p for p in (state / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    shutil.copytree(state, tmp_path / "state2", ignore=lambda _, names: {commits[-1].name, f".{commits[-1].name}.crc"} & set(names))
    state = tmp_path / "state2"
    assert run() == second


def test_a_batch_of_one_file_is_decoded_by_many_tasks(spark, rows, tmp_path):
    """However few files a batch has; the text is kept of what goes to the quarantine."""
    inbox, good, bad = (str(tmp_path / n) for n in ("in", "good", "bad"))
    texts = [("LP%d" % i, json.dumps({"Track Info": [{"Face": "A"}]}) if i % 3 else "{cut}") for i in range(60)]
    spark.createDataFrame(texts, "lp_id string, response string").coalesce(1).write.parquet(inbox)
    arriving = arrival.arriving_table(spark, inbox, T.StructType.fromDDL("lp_id string, response string"))
    arrival.process_split(arriving, extract.track_rows, good, bad, str(tmp_path / "state"), per_task=10, keep_text=False)
    assert rows(spark.read.parquet(good), "LP_ID") == sorted(((lp,) for lp, t in texts if t != "{cut}"), key=str)
    assert rows(spark.read.parquet(bad), "lp_id", "response", "reason") == sorted(((lp, t, "invalid_json") for lp, t in texts if t == "{cut}"), key=str)
    assert len(list((tmp_path / "good" / "batch=0").glob("part-*"))) == 6


def test_catalogue_order_is_shared_by_rows(spark, rows, tmp_path, monkeypatch):
    """So many rows to a task, in order over all tasks; their places are found without the files' names in the rows."""
    lines = [(i % 37, i, 1) for i in range(1000)]
    spark.createDataFrame(lines, "l_partkey long, l_orderkey long, l_linenumber int").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    frame = spark.createDataFrame([(f"LP{p}", o) for p, o, _ in lines], "LP_ID string, seq long")
    parts = catalogue.in_order(frame, 9).rdd.glom().map(len).collect()
    assert len(parts) == 9 and max(parts) < 500
    got = [(r["LP_ID"], r["seq"]) for r in catalogue.in_order(frame, 9).collect()]
    assert got == [(f"LP{p}", o) for p, o, _ in sorted(lines)]
    monkeypatch.setattr(queries, "ROWS_PER_TASK", 100)
    placed = queries.catalogue_in_order(spark, str(tmp_path))
    assert placed.rdd.getNumPartitions() == 11
    assert rows(placed) == sorted(((f"LP{p}", f"{o}-1", o // 37 + 1) for p, o, _ in lines), key=str)
