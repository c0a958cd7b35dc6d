"""Chained trending keeps the slides of two blocks, not the counts of twenty windows."""

import random

from test_streams import NOW, ev, write_batches
from tidewatch.sources import deduplicated, from_json_files, watermarked
from tidewatch.streaming import registry
from tidewatch.streaming.app import await_all
from tidewatch.streaming.jobs import start_trending

COLUMNS = ["window_start", "window_end", "article_title", "server_name", "edit_count"]


def table(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).select(*COLUMNS).collect()), key=repr)


def test_blocks_equal_windows_with_a_tenth_of_the_state_rows(spark, scratch):
    rng = random.Random(11)
    days = [sorted(rng.randrange(7200) for _ in range(150)) for _ in range(3)]
    batches = [[ev(9000 * d + t, "a", None if t % 9 == 0 else f"P{t % 4}") for t in ts] for d, ts in enumerate(days)]
    batches += [[ev(90_000, "z", "F")], [ev(90_001, "z", "F")]]
    src = from_json_files(spark, write_batches(f"{scratch}/in", batches), watermark=False)
    twice = from_json_files(spark, write_batches(f"{scratch}/in2", [b + b for b in batches]), watermark=False)
    chained = start_trending(src, f"{scratch}/chained", f"{scratch}/c1", trigger=NOW, method="chained", query_name="chained")
    direct = start_trending(src, f"{scratch}/direct", f"{scratch}/c2", trigger=NOW, method="direct", query_name="direct")
    once = start_trending(deduplicated(watermarked(twice)), f"{scratch}/once", f"{scratch}/c3", trigger=NOW, method="chained", query_name="once")
    await_all([chained, direct, once])
    assert table(spark, f"{scratch}/chained") == table(spark, f"{scratch}/direct") == table(spark, f"{scratch}/once") != []
    rows = {q.name: sum(o["numRowsUpdated"] for p in q.recentProgress for o in p["stateOperators"]) for q in (chained, direct)}
    assert 3 * rows["chained"] < rows["direct"]


def test_the_deduplicated_feed_is_counted_by_slide_first(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(registry, "_run", lambda *args, **kw: seen.update(kw))
    monkeypatch.setattr(registry, "_trending_of", lambda *args: None)
    registry.q_trending_dedup(spark, "unused")
    assert seen["method"] == "chained" and seen["kind"] == "twice"
