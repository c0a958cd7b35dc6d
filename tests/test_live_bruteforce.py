"""The batch-boundary-dependent (defined) stream behaviours, checked against a
plain Python model of the same rules on the whole sf0.001 events table.

The replay delivers one micro-batch per UTC day, in order, followed by two
flush batches; no row is late, so the model only needs the batch order.
"""

from collections import defaultdict

import pandas as pd

from tidewatch.plans.registry import _edits
from tidewatch.streaming import registry

from data_dirs import SF001

HOUR_MS = 3_600_000
DELAY_MS = 600_000


def _wire_edits(spark):
    e = _edits(spark, SF001).select("user", "title", "timestamp").toPandas()
    e["ms"] = e["timestamp"] * 1000
    e["day"] = e["timestamp"] // 86_400
    return e.sort_values(["day", "ms"])


def model_editors(e):
    out, state, max_seen = [], {}, None
    days = sorted(e["day"].unique())
    batches = [e[e["day"] == d] for d in days]
    flush_ms = int(e["ms"].max()) + 86_400_000
    batches += [pd.DataFrame({"user": ["__flush__"], "ms": [flush_ms]}),
                pd.DataFrame({"user": ["__flush__"], "ms": [flush_ms + 1000]})]
    for b in batches:
        wm = None if max_seen is None else max_seen - DELAY_MS  # watermark of the previous batch
        for user, g in b.groupby("user"):
            total, last = state.get(user, (0, 0))
            total += len(g)
            last = max(last, int(g["ms"].max()))
            state[user] = (total, last)
            out.append((user, total, last, False))
        if wm is not None:
            for user in [u for u in state if u not in set(b["user"])]:
                total, last = state[user]
                if last + HOUR_MS <= wm:
                    out.append((user, total, last, True))
                    del state[user]
        max_seen = max(int(b["ms"].max()), max_seen or 0)
    return [r for r in out if r[0] != "__flush__"]


def test_editors_live_matches_model(spark):
    got = registry.q_editors_live(spark, SF001).toPandas()
    got_rows = sorted((r.user, r.total_edits, int(pd.Timestamp(r.last_activity).value // 1_000_000), r.is_expired)
                      for r in got.itertuples())
    assert got_rows == sorted(model_editors(_wire_edits(spark)))


def model_spikes(e, keep=10, mult=5.0):
    out, hist = [], defaultdict(list)
    for _, b in e.groupby("day", sort=True):
        b = b.assign(w=(b["ms"] // 60_000) * 60_000)
        for title, g in b.groupby("title"):
            w = int(g["w"].max())
            n = int((g["w"] == w).sum())
            h = hist[title]
            avg = sum(h) / len(h) if h else 0.0
            out.append((title, w, n, avg, 0.0 if avg == 0 else n / avg, bool(h) and n > avg * mult))
            hist[title] = (h + [n])[-keep:]
    return out


def test_spikes_live_matches_model(spark):
    got = registry.q_spikes_live(spark, SF001).toPandas()
    got_rows = sorted((r.article_title, int(pd.Timestamp(r.window_start).value // 1_000_000), r.current_edit_count,
                       round(r.historical_average, 9), round(r.spike_multiplier, 9), bool(r.is_spike))
                      for r in got.itertuples())
    exp = sorted((t, w, n, round(a, 9), round(x, 9), s) for t, w, n, a, x, s in model_spikes(_wire_edits(spark)))
    assert got_rows == exp
