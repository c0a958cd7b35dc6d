"""Keyed state for the two continuous analyses.

Both run under ``groupBy(key).transformWithState(...)`` (``api="rows"``) or
``transformWithStateInPandas(...)`` (``api="frames"``) on the RocksDB state
store, so state lives on the executors, partitioned by key, and is
checkpointed with the query.  The state keeps O(1) (editors) or O(history)
(spikes) values per editor or title.

Every call to the state server is a round trip from Python, about a millisecond a
key and micro-batch with the timer.  Editors are many with few edits each, so their key
is a bucket of editors: a bucket's rows and its editors' open spans are arrays, worked on
together, and it has one state value and one timer, that of its first deadline.  Titles
are keyed one by one; an unchanged timer costs no state-server call.

Frames pay a pandas DataFrame per key, rows pay a Python object per row: frames are the
choice for editors, where a key has many rows; for titles either will do.
Times cross the boundary as epoch milliseconds computed in the JVM; output
millis are turned back into timestamps by the caller (``jobs.py``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators.spikes import spike_step

# The processors (and the pure spike rule they call) travel to the Python
# workers by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[spike_step.__module__])

EDITOR_STATE = "user array<string>, total array<long>, last_ms array<long>, span_ms array<long>, timer_ms long"
EDITOR_OUT = "user string, total_edits long, last_ms long, is_expired boolean, span_ms long"
SPIKE_STATE = "hist array<long>, timer_ms long"
SPIKE_OUT = ("article_title string, start_ms long, end_ms long, current_edit_count long, "
             "historical_average double, spike_multiplier double, is_spike boolean")


def _move_timer(handle: StatefulProcessorHandle, old_ms, new_ms: int) -> int:
    """Replace the key's registered timer; no state-server call when it is unchanged."""
    new_ms = int(new_ms)
    if old_ms != new_ms:
        if old_ms is not None:
            handle.deleteTimer(int(old_ms))
        handle.registerTimer(new_ms)
    return new_ms


EDITOR_COLS = ["user", "total_edits", "last_ms", "is_expired", "span_ms"]
EDITOR_BUCKETS = 64  # keys of the editor state
SPIKE_COLS = ["article_title", "start_ms", "end_ms", "current_edit_count", "historical_average",
              "spike_multiplier", "is_spike"]


def split_spans(times: np.ndarray, total: int, last, span, idle_ms: int, counts: np.ndarray | None = None):
    """Strict-gap update on one key's sorted batch times (epoch ms), each standing for ``counts`` edits (one).

    Returns (closed spans as (total, last, span) tuples, new (total, last, span)).
    A span closes at any gap >= ``idle_ms`` from the running latest time."""
    n = len(times)
    if n == 0:
        return [], (total, last, span)
    counts = np.ones(n, "int64") if counts is None else counts
    lead = times[0] if last is None else last
    prev = np.maximum.accumulate(np.concatenate(([lead], times)))[:-1]
    brk = (times - prev) >= idle_ms
    if last is None:
        brk[0] = False
    starts = np.flatnonzero(brk)
    bounds = np.concatenate(([0], starts, [n]))
    closed = []
    cur_total, cur_last, cur_span = total, last, span if last is not None else int(times[0])
    for k in range(len(bounds) - 1):
        lo, hi = bounds[k], bounds[k + 1]
        if k > 0:
            closed.append((cur_total, cur_last, cur_span))
            cur_total, cur_last, cur_span = 0, None, int(times[lo])
        if hi > lo:
            seg_max = int(times[hi - 1])
            cur_total += int(counts[lo:hi].sum())
            cur_last = seg_max if cur_last is None else max(cur_last, seg_max)
    return closed, (cur_total, cur_last, cur_span)


@dataclass
class Spans:
    """Spans of editors, a place of each array per span; ``who`` numbers the editors."""
    who: np.ndarray
    total: np.ndarray
    last: np.ndarray
    span: np.ndarray

    def at(self, places: np.ndarray) -> Spans:
        return Spans(self.who[places], self.total[places], self.last[places], self.span[places])


def advance_spans(held: Spans, who: np.ndarray, times: np.ndarray, counts: np.ndarray, idle_ms: int,
                  strict_gap: bool) -> tuple[Spans, Spans]:
    """Update of many editors at once by a batch of (editor, epoch ms, edits) in any order.

    ``held`` has the open span of editors 0, 1, ...; greater numbers in ``who`` are new
    editors.  Returns the spans that closed and the open ones of the editors in the batch.
    With ``strict_gap`` this is ``split_spans`` for each editor."""
    k = len(held.who)
    order = np.lexsort((times, who))
    who, times, counts = who[order], times[order], counts[order]
    first = np.ones(len(who), bool)
    first[1:] = who[1:] != who[:-1]
    known = who < k
    slot = np.where(known, who, 0)
    of_held = (lambda x, other: np.where(known, x[slot], other)) if k else (lambda x, other: other)
    if strict_gap:
        before = np.where(first, of_held(held.last, times), np.roll(times, 1))
        gap = times - np.maximum(before, of_held(held.last, before)) >= idle_ms
        gap &= ~first | known
    else:
        gap = np.zeros(len(who), bool)
    starts = np.flatnonzero(first | gap)
    ends = np.append(starts[1:], len(who)) - 1
    goes_on = (first & known & ~gap)[starts]
    total, last, span = np.add.reduceat(counts, starts), times[ends], times[starts]
    if not strict_gap:
        last = np.maximum(last, 0)  # a new editor starts from epoch 0
    if k:
        at = slot[starts]
        total = total + np.where(goes_on, held.total[at], 0)
        last = np.where(goes_on, np.maximum(last, held.last[at]), last)
        span = np.where(goes_on, held.span[at], span)
    runs = Spans(who[starts], total, last, span)
    newest = np.append(first[starts][1:], True)
    left = held.at(who[first & known & gap])
    done = runs.at(~newest)
    closed = Spans(*(np.concatenate([getattr(left, f.name), getattr(done, f.name)]) for f in fields(Spans)))
    return closed, runs.at(newest)


class EditorProcessor(StatefulProcessor):
    """Running edit count and last activity per editor, expired ``idle_ms`` of
    event time after the last edit (the watermark must pass the deadline).

    The key is a bucket of editors (``pmod(xxhash64(user), buckets)``); its state value
    holds the open spans of its editors as arrays and its timer stands at the first of
    their deadlines.  Input rows are partial counts (user, event_ms, edits), one per task
    and second where the stream was combined before the shuffle, so a hot editor costs no
    more rows than that.

    ``strict_gap=False`` is the defined behaviour: every edit of a batch is added
    to the running total whatever its gap.  ``strict_gap=True`` closes the span at any
    gap of ``idle_ms`` or more, emitting the old span as expired first; for in-order
    input its final rows equal the batch twin ``editor_spans`` regardless of
    micro-batch boundaries.
    """

    def __init__(self, idle_ms: int, strict_gap: bool = False, frames: bool = False):
        self.idle_ms = int(idle_ms)
        self.strict_gap = strict_gap
        self.frames = frames

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("editor", EDITOR_STATE)

    def _held(self) -> tuple[list, Spans, int | None]:
        """The bucket's editors with an open span, the spans, and its timer."""
        cur = self.state.get()
        if cur is None:
            return [], Spans(*(np.zeros(0, "int64") for _ in range(4))), None
        return list(cur[0]), Spans(np.arange(len(cur[0])), *(np.array(c, "int64") for c in cur[1:4])), cur[4]

    def _keep(self, users: list, spans: Spans, timer) -> None:
        timer = _move_timer(self.handle, timer, spans.last.min() + self.idle_ms)
        self.state.update((users, spans.total.tolist(), spans.last.tolist(), spans.span.tolist(), timer))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        if self.frames:
            parts = [(pdf["user"].tolist(), pdf["event_ms"].to_numpy("int64"), pdf["edits"].to_numpy("int64")) for pdf in rows]
            names = [u for p in parts for u in p[0]]
            times, counts = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
        else:
            names, times, counts = zip(*[(r.user, r.event_ms, r.edits) for r in rows])
            times, counts = np.array(times, "int64"), np.array(counts, "int64")
        users, held, timer = self._held()
        # editors are numbered in order of appearance: those held first, as they lie in the state
        coded = pa.array([*users, *names], pa.string(), from_pandas=True).dictionary_encode("encode")
        who = coded.indices.to_numpy()[len(users):].astype("int64")
        users = coded.dictionary.to_pylist()
        closed, now = advance_spans(held, who, times, counts, self.idle_ms, self.strict_gap)
        spans = Spans(np.arange(len(users)), *(np.concatenate([c, np.zeros(len(users) - len(c), "int64")])
                                               for c in (held.total, held.last, held.span)))
        spans.total[now.who], spans.last[now.who], spans.span[now.who] = now.total, now.last, now.span
        self._keep(users, spans, timer)
        yield from self._emit(users, closed, True)
        yield from self._emit(users, now, False)

    def _emit(self, users: list, spans: Spans, expired: bool):
        if not len(spans.who):
            return
        names = [users[i] for i in spans.who.tolist()]
        if self.frames:
            yield pd.DataFrame(dict(zip(EDITOR_COLS, (names, spans.total, spans.last, np.full(len(names), expired), spans.span))))
        else:
            for u, t, last, sp in zip(names, spans.total.tolist(), spans.last.tolist(), spans.span.tolist()):
                yield Row(user=u, total_edits=t, last_ms=last, is_expired=expired, span_ms=sp)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        users, held, _ = self._held()
        over = held.last + self.idle_ms < timerValues.getCurrentWatermarkInMs()
        stay = held.at(~over)
        if len(stay.who):
            self._keep([users[i] for i in stay.who.tolist()], stay, None)  # the timer has fired; nothing to delete
        else:
            self.state.clear()
        yield from self._emit(users, held.at(over), True)

    def close(self) -> None:
        pass


class SpikeProcessor(StatefulProcessor):
    """Rolling history of window counts per title and the spike rule.

    ``mode='final'``: input windows are final (append-mode aggregate); every
    window of the batch is scored in ``start`` order, one row each.
    ``mode='live'``: input windows are partial updates (update-mode aggregate);
    only the latest window of the batch is scored and its partial count enters
    the history -- the defined behaviour, which depends on batch boundaries.

    Expiry: ``ttl_ms`` after the last update, in processing time (default) or,
    with ``event_time=True``, after the latest window end in event time.  An
    expired title emits a sentinel (counts 0, window times at epoch 0, no spike)
    and forgets its history.
    """

    def __init__(self, history: int, multiplier: float, ttl_ms: int, mode: str = "final",
                 event_time: bool = False, frames: bool = False):
        self.frames = frames
        self.history = int(history)
        self.multiplier = float(multiplier)
        self.ttl_ms = int(ttl_ms)
        self.mode = mode
        self.event_time = event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("spike", SPIKE_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        title = key[0]
        cur = self.state.get()
        hist = [int(x) for x in cur[0]] if cur is not None and cur[0] is not None else []
        timer = cur[1] if cur is not None else None
        if self.frames:
            parts = [(pdf["start_ms"].to_numpy("int64"), pdf["end_ms"].to_numpy("int64"),
                      pdf["edit_count"].to_numpy("int64")) for pdf in rows]
            starts, ends, counts = (np.concatenate(c) for c in zip(*parts)) if len(parts) > 1 else parts[0]
        else:
            trip = [(r.start_ms, r.end_ms, r.edit_count) for r in rows]
            starts, ends, counts = (np.fromiter((x[k] for x in trip), "int64", len(trip)) for k in range(3))
        order = np.lexsort((ends, starts))
        if self.mode == "live":
            order = order[-1:] if ends.size and ends[order[-1]] == ends.max() else [int(np.argmax(ends))]
        cols = {c: [] for c in SPIKE_COLS}
        for i in order:
            n = int(counts[i])
            avg, ratio, spike, hist = spike_step(hist, n, self.history, self.multiplier)
            for c, v in zip(SPIKE_COLS, (title, int(starts[i]), int(ends[i]), n, float(avg), float(ratio), bool(spike))):
                cols[c].append(v)
        base = int(ends.max()) if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        timer = _move_timer(self.handle, timer, base + self.ttl_ms)
        self.state.update((hist, timer))
        yield from self._emit(cols)

    def _emit(self, cols: dict):
        if self.frames:
            yield pd.DataFrame(cols)
        else:
            for vals in zip(*(cols[c] for c in SPIKE_COLS)):
                yield Row(**dict(zip(SPIKE_COLS, vals)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.clear()
        yield from self._emit({c: [v] for c, v in zip(SPIKE_COLS, (key[0], 0, 0, 0, 0.0, 0.0, False))})

    def close(self) -> None:
        pass
