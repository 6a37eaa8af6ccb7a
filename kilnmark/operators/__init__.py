from kilnmark.operators.latest import current_row, last_write, latest_average
from kilnmark.operators.merge import both_feeds, duplicate_rows, duplicate_summary, merge_events, merge_sensor_lab
from kilnmark.operators.ordering import chronological, chronological_rank
from kilnmark.operators.reshape import hour_map, hour_row, meters_to_rows, rows_to_meters, to_series
from kilnmark.operators.running import (
    average_messages,
    keyed_running_table,
    running_averages,
    running_averages_of_readings,
    running_table,
)
from kilnmark.operators.segments import first_marker_day, interval, markers, segment_averages, segment_table
from kilnmark.operators.skew import join_spread

__all__ = [name for name in dir() if not name.startswith("_")]
