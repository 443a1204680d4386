"""Paid calls: the ledger, the window of calls in flight, the quota that all callers share."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sleeveworks.operators.calls import Ledger, Slots, Window
from sleeveworks.operators.enrich import enrich
from sleeveworks.sources.places import located, put_in_place


def said(path):
    return path.read_text().split("\n")[:-1] if path.exists() else []


def test_a_killed_task_pays_for_nothing_twice(spark, rows, tmp_path):
    """A task dies after some calls; the next run makes exactly the others."""
    log, ledger = tmp_path / "calls.log", str(tmp_path / "a b#c%20d")
    prompts = [f"prompt {i} é" for i in range(12)]
    df = spark.createDataFrame([(p,) for p in prompts], "prompt string").coalesce(1)

    def model(limit):
        def make():
            def answer(prompt):
                if limit is not None and len(said(log)) >= limit:
                    os._exit(1)
                with open(log, "a") as f:
                    f.write(prompt + "\n")
                return prompt.upper()
            return answer
        return make

    with pytest.raises(Exception, match="(?i)worker|crashed|exited|EOF"):
        enrich(df, model(5), {"out": "prompt"}, ledger=ledger).collect()
    assert said(log) == prompts[:5] and Ledger(ledger).count() == 5
    got = enrich(df, model(None), {"out": "prompt"}, ledger=ledger)
    assert rows(got, "prompt", "out") == sorted((p, p.upper()) for p in prompts)
    assert said(log) == prompts
    assert len(got.collect()) == 12 and len(said(log)) == 12


def test_ledger(tmp_path):
    ledger = Ledger(f"file:{tmp_path}/l")
    assert ledger.get(Ledger.key("x")) == (False, None) and ledger.count() == 0
    for question, answer in [("x", "é"), ("y", None), (1.5, 2.5), (b"\xff", [1, {"a": None}]), ("x\ud800", "lone")]:
        ledger.put(Ledger.key(question), answer)
        ledger.put(Ledger.key(question), answer)
        assert ledger.get(Ledger.key(question)) == (True, answer)
    assert ledger.count() == 5 and Ledger.key("1") != Ledger.key(1)
    assert not [f for _, _, files in os.walk(tmp_path) for f in files if f.startswith(".")]


def test_errors_are_not_kept(tmp_path):
    asked = []

    def make():
        def answer(x):
            asked.append(x)
            if len(asked) < 3:
                raise OSError("busy")
            return x
        return answer

    for expected in [(None, "OSError: busy"), (None, "OSError: busy"), ("q", None), ("q", None)]:
        assert list(Window(make, ledger=Ledger(str(tmp_path))).answers(["q"])) == [expected]
    assert len(asked) == 3


@pytest.mark.parametrize("size", [1, 2, 5])
def test_window_overlaps_and_keeps_order(size):
    lock, running, most, made = threading.Lock(), [0], [0], []

    def make():
        made.append(1)

        def call(x):
            with lock:
                running[0] += 1
                most[0] = max(most[0], running[0])
            time.sleep(0.02 if x % 3 else 0.05)
            with lock:
                running[0] -= 1
            if x == 7:
                raise ValueError("seven")
            return x * 10
        return call

    values = [*range(40), None, 3]
    start = time.monotonic()
    got = list(Window(make, size).answers(iter(values)))
    took = time.monotonic() - start
    assert got == [(None, None) if v is None else (None, "ValueError: seven") if v == 7 else (v * 10, None) for v in values]
    assert most[0] == size and len(made) == size
    assert took > 1.2 / size * 0.9


def test_timeout_frees_the_window():
    """A call that hangs costs its own value only; its client is not used again."""
    hang, made = threading.Event(), []

    def make():
        mine = object()
        made.append(mine)

        def call(x):
            if x in (2, 5):
                hang.wait(30)
            return x
        return call

    start = time.monotonic()
    got = list(Window(make, 2, timeout=0.2).answers(range(10)))
    assert time.monotonic() - start < 5
    assert got == [(None, "TimeoutError: no answer within 0.2 s") if x in (2, 5) else (x, None) for x in range(10)]
    assert 3 <= len(made) <= 4
    hang.set()


def test_a_late_answer_goes_to_the_ledger(tmp_path):
    ledger = Ledger(str(tmp_path))

    def make():
        def slow(x):
            time.sleep(0.3)
            return x
        return slow

    assert list(Window(make, 2, timeout=0.1, ledger=ledger).answers(["a"]))[0][0] is None
    time.sleep(0.6)
    assert list(Window(make, 2, timeout=0.1, ledger=ledger).answers(["a"])) == [("a", None)]


def test_equal_questions_in_flight_are_asked_once(tmp_path):
    asked = []

    def make():
        def call(x):
            asked.append(x)
            time.sleep(0.05)
            return x
        return call

    got = list(Window(make, 4, ledger=Ledger(str(tmp_path))).answers(["a", "a", "b", "a", "b"]))
    assert [r for r, _ in got] == ["a", "a", "b", "a", "b"] and sorted(asked) == ["a", "b"]


def most_in(times, period):
    times = sorted(times)
    return max(sum(t <= u < t + period for u in times) for t in times)


def test_slots_keep_any_period():
    """Callers that are late at random never make more calls in a period than allowed."""
    import random
    draw = random.Random(1)
    for calls, callers in [(1, 1), (3, 2), (10, 4), (7, 5)]:
        times = []
        for caller in range(callers):
            slots, clock = Slots(calls, caller, callers, begin=100.0, period=60.0), [99.0]

            def sleep(s):
                clock[0] += s + draw.choice([0, 0, 0.01, slots.late, 2 * slots.late, 61])

            for _ in range(60):
                slots.wait(lambda: clock[0], sleep)
                times.append(clock[0])
                clock[0] += draw.choice([0, 0, 1, 90]) * draw.random()
        assert most_in(times, 60.0) <= calls


def test_callers_share_one_quota(spark):
    """Call times of all tasks of one query."""
    def make():
        return lambda _: time.time()

    df = spark.range(24).select(F.col("id").cast("string").alias("t"))
    out = enrich(df, make, {"at": "t"}, T.DoubleType(), workers=3, calls_per_minute=600, in_flight=2)
    at = sorted(r["at"] for r in out.collect())
    assert len(at) == 24 and at[-1] - at[0] >= 23 * 0.1 * 0.9
    # A tenth of a minute's quota in any tenth of a minute, and one more for its edges.
    assert most_in(at, 1.0) <= 11


def test_too_few_cores_fail_at_once(spark):
    with pytest.raises(ValueError, match="need as many cores"):
        enrich(spark.range(1).selectExpr("'x' AS t"), lambda: str, {"o": "t"}, workers=1000, calls_per_minute=10)
    with pytest.raises(ValueError, match="needs workers"):
        enrich(spark.range(1).selectExpr("'x' AS t"), lambda: str, {"o": "t"}, calls_per_minute=10)


def test_located():
    for path in ("/a b/c#d%20e", "file:/a b/c#d%20e", "file:///a b/c#d%20e"):
        assert located(path)[1] == "/a b/c#d%20e"


def test_put_in_place_where_a_store_refuses(tmp_path):
    class Strict:
        """Refuses to move over a file, as some stores do."""

        def __init__(self):
            self.own, _ = located(str(tmp_path))

        def __getattr__(self, name):
            return getattr(self.own, name)

        def move(self, draft, place):
            if os.path.exists(place):
                raise OSError("exists")
            self.own.move(draft, place)

    old, new = tmp_path / "old", tmp_path / "new"
    old.write_text("old")
    new.write_text("new")
    put_in_place(Strict(), str(new), str(old))
    assert old.read_text() == "new" and not new.exists()
    with pytest.raises(OSError):
        put_in_place(Strict(), str(new), str(old))
    assert old.read_text() == "new"


def test_a_run_under_a_quota(spark, rows, tmp_path):
    """Stage 2 of a run whose callers share a quota, several calls at a time."""
    import datetime as dt
    import json

    from sleeveworks.plans.catalogue import Run

    (tmp_path / "texts").mkdir()
    for i in range(6):
        (tmp_path / "texts" / f"LP{i}_combined.txt").write_text(f"cover {i}")
    run = Run(spark, str(tmp_path), str(tmp_path / "work"), "A. B", "", dt.date(2024, 9, 5), workers=2, calls_per_minute=1200, in_flight=2, timeout=30)
    run.load_texts(str(tmp_path / "texts"))
    run.ask_model("Extract.\n", lambda: lambda prompt: json.dumps({"Track Info": [{"Face": prompt[-1]}]}))
    assert rows(run.table("extractions"), "lp_id") == [(f"LP{i}",) for i in range(6)]
    assert not os.path.exists(tmp_path / "work" / "ledger" / "responses")
