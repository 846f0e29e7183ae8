"""Time arguments and epoch conversions; naive always means UTC."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Duration suffixes and their seconds.
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400}


def parse_duration(text: str) -> timedelta:
    """``30s``, ``15m``, ``2h`` or ``1d``."""
    found = re.fullmatch(r"([+-]?\d+)([smhd])", text)
    if not found:
        raise ValueError(f"a duration looks like 30s/15m/2h/1d, not {text!r}")
    return timedelta(seconds=int(found[1]) * UNIT_SECONDS[found[2]])


def resolve_time(text: str, reference: datetime) -> datetime:
    """ISO text, ``now``, or a look-back such as ``-30m`` from ``reference``; result in UTC."""
    base = reference if reference.tzinfo else reference.replace(tzinfo=timezone.utc)
    if text.lower() == "now":
        return base.astimezone(timezone.utc)
    if re.fullmatch(r"-.*[smhd]", text):
        return (base - parse_duration(text[1:])).astimezone(timezone.utc)
    try:
        moment = datetime.fromisoformat(text)
    except ValueError as error:
        raise ValueError(f"a time is ISO 8601, 'now' or -30m/-2h/-1d, not {text!r}") from error
    return (moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)).astimezone(timezone.utc)


def time_literal(moment: datetime, like: str = "timestamp") -> Column:
    """A literal of the column's own type, so that the comparison is pushed into the scan."""
    utc = moment.astimezone(timezone.utc) if moment.tzinfo else moment
    return F.lit(utc.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(like)


def iso_utc(moment: Column) -> Column:
    """ISO 8601 with a numeric zone; microseconds appear only when they are not zero."""
    stamp = moment.cast("timestamp")
    whole = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(stamp, ".SSSSSS")
    return F.concat(whole, F.when(micros == ".000000", F.lit("")).otherwise(micros), F.lit("+00:00"))


def iso_from_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds to ISO text; NULL becomes the empty string."""
    return F.coalesce(iso_utc(F.timestamp_millis(ms)), F.lit(""))


def epoch_ms(moment: Column) -> Column:
    return F.unix_millis(moment.cast("timestamp"))


def time_slice(moment: Column, seconds: int) -> Column:
    """The number of the fixed-width slice a moment falls into (epoch-aligned)."""
    return F.floor(F.unix_seconds(moment.cast("timestamp")) / F.lit(seconds))
