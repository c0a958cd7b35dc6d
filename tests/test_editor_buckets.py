"""Editors kept in buckets: state calls by bucket, not by editor, and the spans of every editor as before."""

import random

import numpy as np

from test_streams import NOW, ev, write_batches
from tidewatch.sources import from_json_files
from tidewatch.streaming.app import await_all
from tidewatch.streaming.jobs import start_editors
from tidewatch.streaming.processors import Spans, advance_spans, split_spans

IDLE = 3_600_000


def test_many_editors_at_once_equal_one_by_one():
    rng = random.Random(5)
    for _ in range(200):
        k, m, strict = rng.randrange(4), rng.randrange(1, 7), rng.random() < 0.7
        held = Spans(np.arange(k), *(np.array([rng.randrange(1, 9) * s for _ in range(k)], "int64") for s in (1, 1_800_000, 900_000)))
        rows = [(rng.randrange(m), rng.randrange(12) * 1_800_000, rng.randrange(1, 4)) for _ in range(rng.randrange(1, 25))]
        who, times, counts = (np.array(c, "int64") for c in zip(*rows))
        closed, now = advance_spans(held, who, times, counts, IDLE, strict)
        want_closed, want_now = [], []
        for u in sorted(set(who.tolist())):
            order = np.argsort(times[who == u], kind="stable")
            t, n = times[who == u][order], counts[who == u][order]
            state = (int(held.total[u]), int(held.last[u]), int(held.span[u])) if u < k else (0, None, None)
            if strict:
                shut, state = split_spans(t, *state, IDLE, n)
            else:
                shut, state = [], (state[0] + n.sum(), max(state[1] or 0, t.max()), t.min() if u >= k else state[2])
            want_closed += [(u, *map(int, s)) for s in shut]
            want_now.append((u, *map(int, state)))
        as_rows = lambda s: sorted(zip(s.who.tolist(), s.total.tolist(), s.last.tolist(), s.span.tolist()))
        assert as_rows(closed) == sorted(want_closed) and as_rows(now) == want_now


def test_state_grows_with_buckets_not_with_editors(spark, scratch):
    batches = [[ev(k * 7200 + i % 50, None if i == 7 else f"u{i}", "P") for i in range(400)] for k in range(2)]
    src = from_json_files(spark, write_batches(f"{scratch}/in", [*batches, [ev(90_000, "z", "F")], [ev(90_001, "z", "F")]]), watermark=False)
    q = start_editors(src, f"{scratch}/t", f"{scratch}/c", trigger=NOW, buckets=5)
    await_all([q])
    ops = [o for p in q.recentProgress for o in p["stateOperators"]]
    assert max(o["numRowsTotal"] for o in ops) <= 5
    assert max(int(o["customMetrics"]["numRegisteredTimers"]) for o in ops) <= 2 * 5  # one by one: 400
    rows = spark.read.parquet(f"{scratch}/t").where("is_expired AND user IS DISTINCT FROM 'z'").collect()
    assert sum(r.total_edits for r in rows) == 800
    assert len({r.user for r in rows}) == 400 and None in {r.user for r in rows}
