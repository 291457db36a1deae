from shelfcast.functions.semantics import (  # noqa: F401
    any_label, date_lit, gid_suffix, null_greatest, or_default, round_to_long, safe_div, ts_lit, week_start,
)
