from tidewatch.functions.columns import (
    window_bounds, guarded_ratio, is_blank, push_history, history_mean, spike_flag,
    epoch_ms, from_epoch_ms, round2, window_starts_containing, to_ntz,
)

__all__ = [
    "window_bounds", "guarded_ratio", "is_blank", "push_history", "history_mean", "spike_flag",
    "epoch_ms", "from_epoch_ms", "round2", "window_starts_containing", "to_ntz",
]
