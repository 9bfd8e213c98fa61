"""Scalar function library: every function returns a JVM-side Column expression."""

from tidewater.functions.collections import (  # noqa: F401
    bytes_to_gb, divide_trunc, double_elements, factorial_parity, flat_map, map_merge, product_except_self,
    product_nonzero,
)
from tidewater.functions.dates import (  # noqa: F401
    clamp_past, date_series, five_minute_window, format_zone_date, iso_to_epoch, key_date, name_date,
    previous_daily_run, previous_slot, shift_days_hours, throttle_ok, to_zone, whole_days_between,
)
from tidewater.functions.jsonfn import (  # noqa: F401
    json_round_trip, json_value, parse_json_text, polygon_ring, polygon_valid, polygon_wkt, remove_empty,
    to_json_compact,
)
from tidewater.functions.strings import (  # noqa: F401
    camel_to_snake, capacity_percent, concat_nonempty, contains_any, count_char, hash_bucket, hash_filename,
    join_path, path_segment, preplace, snake_to_camel, strip_env_prefix, suffix_match, title_word, trim_all,
)
