"""Paid calls inside a task: a ledger of answers, a bounded window of calls in flight, a shared quota."""

import hashlib
import json
import queue
import threading
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

from pyarrow import fs

from sleeveworks.sources.places import located, put_in_place


class Ledger:
    """Answers that were paid for, one file each, named by the hash of what was asked.

    An answer is written by the task that got it, before its next call, so a task that is lost pays for
    nothing twice. Answers must be JSON values. A file is drafted and moved into place; two tasks that
    ask the same leave one answer.
    """

    def __init__(self, directory: str):
        self._store, self._root = located(directory)

    @staticmethod
    def key(question: Any) -> str:
        body = question if isinstance(question, bytes) else json.dumps(question, ensure_ascii=False).encode("utf-8", "surrogatepass")
        return hashlib.sha256(body).hexdigest()

    def _place(self, key: str) -> str:
        return f"{self._root}/{key[:2]}/{key}.json"

    def get(self, key: str) -> tuple[bool, Any]:
        """Whether there is an answer, and the answer."""
        try:
            with self._store.open_input_stream(self._place(key)) as source:
                return True, json.loads(source.readall())
        except FileNotFoundError:
            return False, None

    def put(self, key: str, answer: Any) -> None:
        place = self._place(key)
        draft = f"{self._root}/{key[:2]}/.{uuid.uuid4().hex}"
        self._store.create_dir(f"{self._root}/{key[:2]}", recursive=True)
        with self._store.open_output_stream(draft) as out:
            out.write(json.dumps(answer).encode())
        put_in_place(self._store, draft, place)

    def count(self) -> int:
        found = self._store.get_file_info(fs.FileSelector(self._root, allow_not_found=True, recursive=True))
        return sum(f.base_name.endswith(".json") for f in found)


class Slots:
    """Times at which one of ``callers`` may begin a call, so that all together keep a quota.

    Times are dealt out in turn, from a beginning that all know, and are so far apart that no ``calls + 1`` of
    them lie within one ``period``, a call being at most ``late`` after its time. A caller that is later
    than that waits for its next time. Clocks of the callers' machines must agree to within a part of ``late``.
    """

    def __init__(self, calls: float, caller: int, callers: int, begin: float, period: float = 60.0, late: float | None = None):
        self.late = min(1.0, period / calls / 2) if late is None else late
        # A little more, so that rounding never brings two times together.
        self.step = (period + self.late) / calls * (1 + 1e-9)
        self.first, self.turn, self.next = begin + caller * self.step, callers * self.step, 0

    def wait(self, now: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep) -> float:
        """Returns when a call may begin."""
        while True:
            due = self.first + self.next * self.turn
            if now() > due + self.late:
                self.next = max(self.next + 1, int((now() - self.first) // self.turn) + 1)
                continue
            sleep(max(0.0, due - now()))
            self.next += 1
            if now() <= due + self.late:
                return due


@dataclass
class _Call:
    value: Any
    done: threading.Event = field(default_factory=threading.Event)
    result: Any = None
    error: str | None = None
    due: float | None = None
    over: bool = False


class Window:
    """Calls a function for values, at most ``size`` at a time, and gives the answers in the order of the values.

    Every call in flight has a function of its own from ``make_function``, so clients need not be safe for
    threads. A call that takes longer than ``timeout`` seconds is given up: its value gets an error, its
    place in the window is free again, and its function is not used any more; its answer, should one come, still
    goes to the ledger. With a ledger, what is asked while the same value is in flight waits for that call.
    """

    #: Answers kept for the order of the output, per call in flight.
    HELD = 8

    def __init__(self, make_function: Callable[[], Callable[[Any], Any]], size: int = 1, timeout: float | None = None,
                 before: Callable[[], Any] | None = None, ledger: Ledger | None = None,
                 convert: Callable[[Any], Any] = lambda x: x):
        if size < 1:
            raise ValueError("a window holds one call at least")
        self._make, self._size, self._timeout = make_function, size, timeout
        self._before, self._ledger, self._convert = before, ledger, convert
        self._functions: queue.SimpleQueue = queue.SimpleQueue()
        self._free = threading.Condition()
        self._running: list[_Call] = []

    def _finish(self, call: _Call, result: Any, error: str | None) -> bool:
        """Ends a call, unless it has ended; the first end counts."""
        with self._free:
            if call.over:
                return False
            call.over, call.result, call.error = True, result, error
            self._running.remove(call)
            self._free.notify_all()
        call.done.set()
        return True

    def _ask(self, function: Callable[[Any], Any], value: Any) -> tuple[Any, str | None]:
        try:
            # Converted here, so that a value of the wrong type is this call's error.
            result = self._convert(function(value))
            if self._ledger is not None:
                self._ledger.put(Ledger.key(value), result)
            return result, None
        except Exception as e:  # one bad value must not fail the others
            return None, f"{type(e).__name__}: {e}"

    def _work(self, call: _Call, function: Callable[[Any], Any]) -> None:
        if self._finish(call, *self._ask(function, call.value)):
            self._functions.put(function)

    def _expire(self) -> float | None:
        """Gives up what took too long; seconds until the next may be."""
        if self._timeout is None:
            return None
        with self._free:
            now = time.monotonic()
            for call in [c for c in self._running if c.due <= now]:
                self._finish(call, None, f"TimeoutError: no answer within {self._timeout:g} s")
            return min((c.due - now for c in self._running), default=None)

    def _function(self) -> Callable[[Any], Any]:
        try:
            return self._functions.get_nowait()
        except queue.Empty:
            return self._make()

    def _known(self, value: Any) -> _Call | None:
        if self._ledger is not None:
            found, answer = self._ledger.get(Ledger.key(value))
            if found:
                return _Call(value, result=answer, over=True)
        return None

    def _start(self, value: Any) -> _Call:
        known = self._known(value)
        if known is not None:
            known.done.set()
            return known
        while True:
            rest = self._expire()
            with self._free:
                if len(self._running) < self._size:
                    break
                self._free.wait(rest)
        function = self._function()
        if self._before is not None:
            self._before()
        call = _Call(value, due=time.monotonic() + self._timeout if self._timeout else None)
        with self._free:
            self._running.append(call)
        # A thread of its own, not a pool's: one that never ends must not keep the task from ending.
        threading.Thread(target=self._work, args=(call, function), daemon=True).start()
        return call

    def answers(self, values: Iterable[Any]) -> Iterator[tuple[Any, str | None]]:
        """``result, error`` of every value; a null is not asked for."""
        if self._size == 1 and self._timeout is None:
            yield from map(self._one, values)
            return
        pending: deque[_Call | None] = deque()
        flying: dict[str, _Call] = {}
        for value in values:
            while len(pending) >= self._size * self.HELD:
                yield self._answer(pending.popleft())
            if value is None:
                pending.append(None)
                continue
            if self._ledger is None:
                pending.append(self._start(value))
                continue
            key = Ledger.key(value)
            if key not in flying or flying[key].over:
                flying = {k: c for k, c in flying.items() if not c.over}
                flying[key] = self._start(value)
            pending.append(flying[key])
        while pending:
            yield self._answer(pending.popleft())

    def _one(self, value: Any) -> tuple[Any, str | None]:
        if value is None:
            return None, None
        known = self._known(value)
        if known is not None:
            return known.result, None
        function = self._function()
        if self._before is not None:
            self._before()
        answer = self._ask(function, value)
        self._functions.put(function)
        return answer

    def _answer(self, call: _Call | None) -> tuple[Any, str | None]:
        if call is None:
            return None, None
        while not call.done.wait(self._expire()):
            pass
        return call.result, call.error
