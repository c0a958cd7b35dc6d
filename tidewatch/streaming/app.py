"""Run the three jobs from one parsed, watermarked stream.

Each query keeps its own checkpoint under ``<root>/checkpoints/<query>`` and
its table under ``<root>/tables/<table>``; restarting with the same root
resumes from the checkpoints (T15).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.config import DEFAULTS, QUERY_NAMES, TABLE_NAMES, Params
from tidewatch.streaming.jobs import start_editors, start_spikes, start_trending


def table_paths(root: str) -> dict[str, str]:
    return {t: f"{root}/tables/{t}" for t in TABLE_NAMES}


def checkpoint_paths(root: str) -> dict[str, str]:
    return {q: f"{root}/checkpoints/{q}" for q in QUERY_NAMES}


def start_all(events: DataFrame, root: str, params: Params = DEFAULTS, trigger: dict | None = None,
              fmt: str = "parquet", spike_mode: str = "final", strict_gap: bool = False, spike_expiry="processing_time",
              spike_ttl: str | None = None):
    """Each job sets the watermark itself; a stream without one lets the editor job combine before its shuffle."""
    tables, ckpts = table_paths(root), checkpoint_paths(root)
    q_trend, q_edit, q_spike = QUERY_NAMES
    return [
        start_trending(events, tables["trending_articles"], ckpts[q_trend], params, trigger, fmt, q_trend),
        start_editors(events, tables["active_editors"], ckpts[q_edit], params, trigger, fmt, q_edit,
                      strict_gap=strict_gap),
        start_spikes(events, tables["edit_spikes"], ckpts[q_spike], params, trigger, fmt, q_spike,
                     mode=spike_mode, expiry=spike_expiry, ttl=spike_ttl),
    ]


def await_any(spark: SparkSession, timeout: float | None = None):
    """Block until any query stops or fails (re-raises its error)."""
    return spark.streams.awaitAnyTermination(timeout) if timeout is not None else spark.streams.awaitAnyTermination()


def await_all(queries) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"query {q.name} failed: {q.exception()}")


def stop_all(spark: SparkSession) -> None:
    for q in spark.streams.active:
        q.stop()
