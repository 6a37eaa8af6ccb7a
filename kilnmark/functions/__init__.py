from kilnmark.functions.keys import (
    batch_key,
    batch_key_time,
    cell_key,
    path_label,
    running_key,
    running_key_time,
)
from kilnmark.functions.timestamps import (
    archive_day,
    archive_window,
    day_text,
    display_time,
    instant,
    local_time,
    minutes_before,
    parse_day,
    wall_clock,
)
from kilnmark.functions.values import (
    empty_to_null,
    is_on,
    meter_message,
    message_value,
    number,
    round2,
    status_label,
    zero_pad,
)

__all__ = [name for name in dir() if not name.startswith("_")]
