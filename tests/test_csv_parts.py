"""CSV files read in ranges, against Spark's reader and against the whole file."""

import csv
import io
import random

import pytest

from sleeveworks.schema import strings
from sleeveworks.sources import csv_parts, files, sinks
from sleeveworks.sources.csv_parts import FUNCTIONS, QUOTED, START, _line_end, effect, read_csv_in_parts


def walk(data, state):
    """States byte by byte, by the rules as they are said."""
    for byte in data:
        c = chr(byte)
        if state == QUOTED:
            state = 3 if c == '"' else QUOTED
        elif c in ",\n":
            state = START
        elif c == '"' and state in (START, 3):
            state = QUOTED
        else:
            state = 1
    return state


def test_effects():
    draw = random.Random(1)
    for _ in range(400):
        data = "".join(draw.choice('ab",\n"') for _ in range(draw.randint(0, 30))).encode()
        assert list(FUNCTIONS[effect(data)]) == [walk(data, s) for s in range(4)]
    assert len(FUNCTIONS) < 100


def made(draw, n):
    pieces = ["", "a", "é ñ", '"', '""', ",", "\n", "\r\n", " x ", "'", "NaN", "日本", "\n\n", '",\n"']
    return [["".join(draw.choice(pieces) for _ in range(draw.randint(0, 4))) for _ in range(3)] for _ in range(n)]


def write(path, rows, line="\n", header=("lp_id", "title", "notes"), quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=line, quoting=quoting)
    writer.writerow(header)
    writer.writerows(rows)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(out.getvalue().encode())


SCHEMA = strings(["title", "lp_id", "more"])


@pytest.mark.parametrize("part, line, quoting", [(7, "\n", csv.QUOTE_MINIMAL), (64, "\r\n", csv.QUOTE_ALL), (1 << 20, "\n", csv.QUOTE_ALL)])
def test_ranges_give_every_record_once(spark, rows, tmp_path, part, line, quoting, monkeypatch):
    monkeypatch.setattr(csv_parts, "LOOK", 16)
    draw = random.Random(part)
    data = [made(draw, 60), made(draw, 1), []]
    for i, part_rows in enumerate(data):
        write(tmp_path / "c" / f"p{i} #.csv", part_rows, line, quoting=quoting)
    got = read_csv_in_parts(spark, str(tmp_path / "c"), SCHEMA, part)
    blank = {"", "NaN"}
    want = sorted(((None if r[1] in blank else r[1], None if r[0] in blank else r[0], None) for p in data for r in p), key=str)
    assert rows(got) == want


def test_equal_to_the_reader(spark, rows, tmp_path):
    """What the library itself writes, and plain files with odd ends."""
    df = spark.createDataFrame([tuple(r) for r in made(random.Random(5), 200)], "lp_id string, title string, notes string")
    sinks.write_csv(df.coalesce(1), str(tmp_path / "own"))
    schema = strings(["lp_id", "title", "notes"])
    whole = rows(files.read_csv(spark, str(tmp_path / "own"), schema))
    got = read_csv_in_parts(spark, str(tmp_path / "own"), schema, 100)
    assert rows(got) == whole and len(whole) == 200
    for name, text in {"no_end": "lp_id,title,notes\na,b,c", "blank": "lp_id,title,notes\n\na,b,c\n\n", "short": "lp_id,title,notes\na,b\nd,e,f,g\n",
                       "plain_quote": 'lp_id,title,notes\na,5" disc,c\n"x\ny",2,3\n'}.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "x.csv").write_text(text)
        for part in (3, 1000):
            assert rows(read_csv_in_parts(spark, str(folder), schema, part)) == rows(files.read_csv(spark, str(folder), schema)), (name, part)


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    write(tmp_path / "c" / "a.csv", [["x", "y\nz", "w"]] * 500)
    got = read_csv_in_parts(spark, str(tmp_path / "c"), SCHEMA, 200)
    held = [r for r in got.rdd.glom().map(len).collect() if r]
    assert len(held) > 2 and sum(held) == 500


def test_nothing_and_headers(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert read_csv_in_parts(spark, str(tmp_path / "none"), SCHEMA).collect() == []
    (tmp_path / "none" / "empty.csv").write_text("")
    assert read_csv_in_parts(spark, str(tmp_path / "none"), SCHEMA).collect() == []
    write(tmp_path / "two" / "a.csv", [["1", "2", "3"]])
    write(tmp_path / "two" / "b.csv", [["1", "2", "3"]], header=("x", "y", "z"))
    with pytest.raises(Exception, match="another header"):
        read_csv_in_parts(spark, str(tmp_path / "two"), SCHEMA).collect()


def test_line_ends(tmp_path):
    text = b'a,"b\nc",d\n"e""\nf"\n'
    file = io.BytesIO(text)
    assert [_line_end(file, at, walk(text[:at], START), len(text)) for at in range(len(text) + 1)] == [
        10 if at < 10 else 18 for at in range(len(text) + 1)]
