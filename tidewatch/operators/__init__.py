from tidewatch.operators.trending import trending
from tidewatch.operators.spikes import minute_counts, spikes, spikes_from_counts, spike_step
from tidewatch.operators.editors import editor_running, editor_spans, editor_step, expired_flag
from tidewatch.operators.snapshot import latest_per_key

__all__ = [
    "trending", "minute_counts", "spikes", "spikes_from_counts", "spike_step",
    "editor_running", "editor_spans", "editor_step", "expired_flag", "latest_per_key",
]
