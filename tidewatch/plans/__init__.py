from tidewatch.plans.serve import top_trending, top_trending_from_events, active_board, spike_board, hourly_heatmap, hourly_heatmap_from_events, table_stats

__all__ = ["top_trending", "top_trending_from_events", "active_board", "spike_board", "hourly_heatmap", "hourly_heatmap_from_events", "table_stats"]
