"""Epoch-millisecond helpers that do not depend on the session time zone.

Day strings and display times are computed on ``TIMESTAMP_NTZ`` values
(wall clock in UTC), so results are identical whatever
``spark.sql.session.timeZone`` the caller runs with.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Fixed display formats of the log layer (12-hour clock, no am/pm marker).
DAY_FORMAT = "yyyy-MM-dd"
DISPLAY_FORMAT = "yyyy-MM-dd hh:mm:ss"
DISPLAY_FORMAT_MS = "yyyy-MM-dd hh:mm:ss:SSS"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_to_ms(ts: Column | str) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> epoch milliseconds (bigint)."""
    return F.expr(f"timestampdiff(MILLISECOND, {_EPOCH_NTZ}, {ts})") if isinstance(ts, str) \
        else F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), ts)


def ms_to_ntz(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ (UTC wall clock)."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(_EPOCH_NTZ))


def ms_to_ts(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP (instant), for watermarks and windows."""
    return F.timestamp_millis(_c(ms))


def ts_to_ms(ts: Column | str) -> Column:
    """TIMESTAMP (instant) -> epoch milliseconds."""
    return F.unix_millis(_c(ts))


def in_zone(ms: Column | str, zone: str = "UTC") -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ (wall clock of ``zone``)."""
    return ms_to_ntz(ms) if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), ms_to_ntz(ms))


def epoch_to_day(ms: Column | str, zone: str = "UTC") -> Column:
    """DAT1: epoch ms -> 'yyyy-MM-dd' in ``zone``."""
    return F.date_format(in_zone(ms, zone), DAY_FORMAT)


def format_event_time(ms: Column | str, millis: bool = True, zone: str = "UTC") -> Column:
    """DAT2: epoch ms -> 'yyyy-MM-dd hh:mm:ss[:SSS]' with a 12-hour clock, in ``zone``."""
    return F.date_format(in_zone(ms, zone), DISPLAY_FORMAT_MS if millis else DISPLAY_FORMAT)


def order_time_parts(create_time: Column | str) -> dict[str, Column]:
    """DAT3: derived order-time columns from a TIMESTAMP_NTZ create time."""
    t = _c(create_time)
    return {
        "create_date": F.date_format(t, DAY_FORMAT),
        "create_hour": F.date_format(t, "HH"),
        "create_ts": ntz_to_ms(t),
    }
