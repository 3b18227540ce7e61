"""The declared schema of every settlement input, and checked reading by it.

A warehouse stores the same facts in many shapes: ids as INT or DECIMAL(20,0),
money as DOUBLE, times as TIMESTAMP (an instant) or TIMESTAMP_NTZ (a wall
clock). The steps compare times as UTC wall clocks and sum money as
DECIMAL(18,2), so inputs are brought to those types once, where they are read:

* a stored instant becomes the wall clock that UTC showed then, whatever the
  session's time zone;
* a lossless change of type is a plain cast (or none), so filters still reach
  the scan; a change that could lose something (a wider integer, money with
  more digits, floating point) is checked row by row and fails, naming table
  and column, rather than rounding;
* columns that are missing or cannot be read as declared are all named in one
  error, before anything runs.

Columns that are not declared are not read. ``<time>_day`` columns (DATE) are
kept if they are stored: see :mod:`settlebook.sources.partitions`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settlebook.functions.timez import DAY, ts_lit
from settlebook.plans import rules as R

ID, CODE, TEXT, MONEY, CENTS, TIME = "id", "code", "text", "money", "cents", "time"
SPARK_TYPES = {ID: T.LongType(), CODE: T.IntegerType(), TEXT: T.StringType(), MONEY: T.DecimalType(18, 2), CENTS: T.LongType(),
               TIME: T.TimestampNTZType()}

_PAYOUT = {"user_id": ID, "currency": TEXT, "country": TEXT, "payout_type": TEXT, "trx_date": TIME, "created": TIME, "changed": TIME,
           "trx_id": ID, "notes": TEXT, "account_type": TEXT, "reason": CODE, "status": CODE, "amount": MONEY, "payment_id": ID,
           "withheld_status": CODE}

# Per input: its columns and what they hold.
CONTRACT: dict[str, dict[str, str]] = {
    "events": {"id": ID, "uid": ID, "event_parent": ID, "current_status": TEXT, "end_date": TIME},
    "users": {"id": ID, "account_type": TEXT},
    "orders": {"id": ID, "event": ID, "currency": TEXT, "gross": MONEY, "mg_fee": MONEY, "payment_type": TEXT, "status": CODE, "changed": TIME},
    "history_orders": {"order_id": ID, "event_id": ID, "gross": MONEY, "mg_fee": MONEY, "payment_type": TEXT, "currency": TEXT, "status": CODE,
                       "changed": TIME, "log_position": ID},
    "order_itemizations": {"order_id": ID, "event_id": ID, "currency": TEXT, "transaction_created": TIME,
                           **{c: CENTS for c in (*R.EPP_COMPONENTS, *R.OFFLINE_DEDUCTIONS)}},
    "history_payouts": {"payout_id": ID, "event_id": ID, **_PAYOUT, "status_old": CODE, "log_position": ID},
    "payouts": {"id": ID, "event": ID, **_PAYOUT},
    "history_payment_options": {"event_id": ID, "changed": TIME, "log_position": ID, R.ACCEPT_PROCESSOR: CODE, R.ACCEPT_PROCESSOR_OLD: CODE,
                                R.ACCEPT_PAYPAL: CODE, R.ACCEPT_AUTHNET: CODE},
    "invoice_charges": {"id": ID, "event": ID, "currency": TEXT, "created": TIME, "changed": TIME, "charge_type": TEXT, "processed": CODE,
                        "amount": MONEY, "payout_id": ID, "parent_id": ID},
    "transfer_orders": {"order_id": ID},
    "event_exclusions": {"event_id": ID},
    "prior_event_level": {"event_id": ID},
    "wire_in_events": {"event_id": ID},
    "manual_voids": {"payout_id": ID},
}


class SchemaError(ValueError):
    """A stored table does not have what the settlement steps read."""


def declared(table: str) -> T.StructType:
    """The table's declared columns as a schema."""
    return T.StructType([T.StructField(c, SPARK_TYPES[kind]) for c, kind in CONTRACT[table].items()])


def _checked(value: Column, fits: Column, table: str, column: str, stored: T.DataType) -> Column:
    said = F.concat(F.lit(f"{table}.{column}: "), F.col(column).cast("string"), F.lit(f" ({stored.simpleString()}) does not fit the declared type"))
    return F.when(F.col(column).isNull() | fits, value).otherwise(F.raise_error(said))


def _whole(table: str, column: str, stored: T.DataType, to: T.DataType) -> Column | None:
    c, widths = F.col(column), {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}
    most = widths[type(to)]
    if type(stored) in widths:
        if widths[type(stored)] <= most:
            return c.cast(to)
        return _checked(c.cast(to), c.between(-(1 << most), (1 << most) - 1), table, column, stored)
    if isinstance(stored, T.DecimalType):
        bound = F.lit(str(1 << most)).cast("decimal(38,0)")
        fits = (c == F.floor(c)) & (c.cast("decimal(38,0)") < bound) & (c.cast("decimal(38,0)") >= -bound)
        return c.cast(to) if stored.scale == 0 and stored.precision <= len(str(1 << most)) - 1 else _checked(c.cast(to), fits, table, column, stored)
    return None


def _money(table: str, column: str, stored: T.DataType) -> Column | None:
    c, to = F.col(column), SPARK_TYPES[MONEY]
    if isinstance(stored, T.DecimalType):
        if stored.scale <= to.scale and stored.precision - stored.scale <= to.precision - to.scale:
            return c.cast(to)
        exact = F.round(c, to.scale) == c if stored.scale > to.scale else F.lit(True)
        return _checked(F.round(c, to.scale).cast(to), exact & (F.abs(c) < F.lit("1e16").cast("decimal(38,0)")), table, column, stored)
    if isinstance(stored, T.FloatType | T.DoubleType):
        cents = c.cast("double") * 100
        tolerance = 1e-3 if isinstance(stored, T.DoubleType) else 0.05
        return _checked(F.round(c.cast("double"), 2).cast(to), (F.abs(cents - F.round(cents)) < tolerance) & (F.abs(cents) < 1e15), table, column, stored)
    if isinstance(stored, T.ByteType | T.ShortType | T.IntegerType):
        return c.cast(to)
    if isinstance(stored, T.LongType):
        return _checked(c.cast(to), c.between(-(10**16 - 1), 10**16 - 1), table, column, stored)
    return None


def _time(column: str, stored: T.DataType) -> Column | None:
    c = F.col(column)
    if isinstance(stored, T.TimestampNTZType | T.DateType):
        return c.cast("timestamp_ntz")
    if isinstance(stored, T.TimestampType):  # by the instant itself: a cast would go through the session's wall clock
        return F.timestamp_add("MICROSECOND", F.unix_micros(c), ts_lit("1970-01-01"))
    return None


def coerced(table: str, column: str, kind: str, stored: T.DataType) -> Column | None:
    """The column as its declared type; None if it cannot be read so."""
    if stored == SPARK_TYPES[kind]:
        return F.col(column)
    if isinstance(stored, T.NullType):
        return F.col(column).cast(SPARK_TYPES[kind])
    if kind in (ID, CODE, CENTS):
        return _whole(table, column, stored, SPARK_TYPES[kind])
    if kind == MONEY:
        return _money(table, column, stored)
    if kind == TIME:
        return _time(column, stored)
    return F.col(column).cast("string") if isinstance(stored, T.StringType | T.VarcharType | T.CharType) else None


def _stored_days(df: DataFrame, table: str) -> list[str]:
    return [c + DAY for c, kind in CONTRACT[table].items() if kind == TIME and c + DAY in df.columns]


def problems(df: DataFrame, table: str) -> list[str]:
    """What keeps ``df`` from being read as ``table``, one line per column."""
    found = []
    for c, kind in CONTRACT[table].items():
        if c not in df.columns:
            found.append(f"{table}.{c}: missing (a {SPARK_TYPES[kind].simpleString()} column)")
        elif coerced(table, c, kind, df.schema[c].dataType) is None:
            found.append(f"{table}.{c}: stored as {df.schema[c].dataType.simpleString()}, needs {SPARK_TYPES[kind].simpleString()}")
    for c in _stored_days(df, table):
        if not isinstance(df.schema[c].dataType, T.DateType):
            found.append(f"{table}.{c}: stored as {df.schema[c].dataType.simpleString()}, needs date")
    return found


def conform(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the declared columns of ``table`` in their declared types
    (and stored day columns); :class:`SchemaError` names all that do not fit."""
    if said := problems(df, table):
        raise SchemaError("\n".join(said))
    cols = [coerced(table, c, kind, df.schema[c].dataType).alias(c) for c, kind in CONTRACT[table].items()]
    return df.select(*cols, *_stored_days(df, table))


def conform_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All inputs by name; one error for everything that does not fit in any of them."""
    if said := [x for name, df in tables.items() for x in problems(df, name)]:
        raise SchemaError("inputs do not have the declared columns:\n  " + "\n  ".join(said))
    return {name: conform(df, name) for name, df in tables.items()}
