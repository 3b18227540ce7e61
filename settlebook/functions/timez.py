"""Wall-clock time helpers.

Source timestamps are TIMESTAMP_NTZ values holding UTC wall clock. The
settlement rules compare the *local* wall clock of a fixed zone, cut to whole
seconds, with date literals. Everything here stays in TIMESTAMP_NTZ so results
do not depend on ``spark.sql.session.timeZone``.

``local_before`` / ``local_at_or_after`` / ``local_between`` rewrite a test on
the local wall clock into a test on the raw UTC column against a constant
computed on the driver. The rewritten predicate is a plain comparison on the
stored column, so Catalyst pushes it into the parquet scan (the wrapped form
would only push ``IS NOT NULL``). The rewrite is exact whenever the bound is
neither inside a DST gap nor inside a repeated (fall-back) hour; for such a
bound the wrapped form is used instead.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the wall-clock zone the settlement cutoffs are written in.
LOCAL_TZ = "America/Los_Angeles"

_EPOCH = "1970-01-01 00:00:00"
_ONE_SECOND = dt.timedelta(seconds=1)


def _parse(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value))


def _fmt(value: dt.datetime) -> str:
    return value.isoformat(sep=" ", timespec="microseconds")


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a date, datetime or ISO string."""
    return F.lit(_fmt(_parse(value))).cast("timestamp_ntz")


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_second(c) -> Column:
    """Truncate an NTZ timestamp to whole seconds without leaving NTZ."""
    c = col_of(c)
    micros = F.timestamp_diff("MICROSECOND", ts_lit(_EPOCH), c)
    return F.timestamp_add("MICROSECOND", -F.pmod(micros, F.lit(1_000_000)), c)


def local_ts(c, tz: str = LOCAL_TZ) -> Column:
    """UTC wall clock -> local wall clock of ``tz``, cut to whole seconds."""
    return floor_second(F.convert_timezone(F.lit("UTC"), F.lit(tz), col_of(c)))


def local_to_utc(bound, tz: str = LOCAL_TZ) -> dt.datetime | None:
    """UTC instant of a local wall-clock bound, or None if the bound is
    ambiguous (repeated hour) or does not exist (DST gap)."""
    local = _parse(bound)
    zone = ZoneInfo(tz)
    early = local.replace(tzinfo=zone, fold=0)
    late = local.replace(tzinfo=zone, fold=1)
    if early.utcoffset() != late.utcoffset():
        return None
    utc = early.astimezone(dt.timezone.utc)
    if utc.astimezone(zone).replace(tzinfo=None) != local:
        return None
    return utc.replace(tzinfo=None)


def _ceil_second(value: dt.datetime) -> dt.datetime:
    if value.microsecond:
        return value.replace(microsecond=0) + _ONE_SECOND
    return value


DAY = "_day"  # suffix of the partition column that holds the UTC date of a time column
_ONE_DAY = dt.timedelta(days=1)
_TICK = dt.timedelta(microseconds=1)


def _date_lit(value: dt.datetime) -> Column:
    return F.lit(value.date().isoformat()).cast("date")


def day_of(df: DataFrame, column: str) -> str | None:
    """The name of the day column of ``column``, or None if ``df`` has none."""
    return column + DAY if column + DAY in df.columns else None


def before(c, bound, day: str | None = None) -> Column:
    """``c < bound`` on the stored column. ``day`` names the partition column that
    holds the UTC date of ``c``, if there is one: the bound it implies is added,
    so that partitions beyond it are not even listed for reading."""
    p = col_of(c) < ts_lit(bound)
    return p if day is None else p & (F.col(day) <= _date_lit(_parse(bound) - _TICK))


def at_or_after(c, bound, day: str | None = None) -> Column:
    """``c >= bound`` on the stored column (``day`` as in :func:`before`)."""
    p = col_of(c) >= ts_lit(bound)
    return p if day is None else p & (F.col(day) >= _date_lit(_parse(bound)))


def local_before(c, bound, tz: str = LOCAL_TZ, day: str | None = None) -> Column:
    """``local_ts(c) < bound``."""
    b = _ceil_second(_parse(bound))
    utc = local_to_utc(b, tz)
    if utc is not None:
        return before(c, utc, day)
    p = local_ts(c, tz) < ts_lit(bound)
    return p if day is None else p & (F.col(day) <= _date_lit(b + _ONE_DAY))


def local_at_or_after(c, bound, tz: str = LOCAL_TZ, day: str | None = None) -> Column:
    """``local_ts(c) >= bound``."""
    b = _ceil_second(_parse(bound))
    utc = local_to_utc(b, tz)
    if utc is not None:
        return at_or_after(c, utc, day)
    p = local_ts(c, tz) >= ts_lit(bound)
    return p if day is None else p & (F.col(day) >= _date_lit(b - _ONE_DAY))


def local_at_or_before(c, bound, tz: str = LOCAL_TZ, day: str | None = None) -> Column:
    """``local_ts(c) <= bound``."""
    b = _parse(bound).replace(microsecond=0) + _ONE_SECOND
    utc = local_to_utc(b, tz)
    if utc is not None:
        return before(c, utc, day)
    p = local_ts(c, tz) <= ts_lit(bound)
    return p if day is None else p & (F.col(day) <= _date_lit(b + _ONE_DAY))


def local_between(c, low, high, tz: str = LOCAL_TZ, day: str | None = None) -> Column:
    """``local_ts(c) BETWEEN low AND high`` (both ends inclusive)."""
    return local_at_or_after(c, low, tz, day) & local_at_or_before(c, high, tz, day)


def effective_local(cols, tz: str = LOCAL_TZ) -> Column:
    """``coalesce(local_ts(c1), local_ts(c2), ...)``: e.g. transaction date,
    falling back to creation time."""
    return F.coalesce(*[local_ts(c, tz) for c in cols])


def effective_before(cols, bound, tz: str = LOCAL_TZ) -> Column:
    """``coalesce(local_ts(c1), local_ts(c2), ...) < bound``, written so that
    each arm is a pushable comparison on a stored column."""
    cols = [col_of(c) for c in cols]
    arms = []
    for i, c in enumerate(cols):
        earlier_null = [p.isNull() for p in cols[:i]]
        arms.append(reduce(lambda a, b: a & b, earlier_null + [c.isNotNull(), local_before(c, bound, tz)]))
    return reduce(lambda a, b: a | b, arms)
