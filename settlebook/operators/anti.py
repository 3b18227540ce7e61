"""Subquery predicates as joins: null-aware NOT IN and IN-under-OR flags."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY = "_set_key"


@dataclass(frozen=True)
class KeySet:
    """The right-hand side of an IN or NOT IN: ``key`` of the rows of ``rows`` where ``where`` holds."""
    rows: DataFrame
    key: str
    where: Column | None = None

    def keys(self) -> DataFrame:
        kept = self.rows if self.where is None else self.rows.where(self.where)
        return kept.select(self.key)


@dataclass(frozen=True)
class Facts:
    """What NOT IN needs to know of a set besides its members."""
    rows: int
    nulls: int


def set_facts(**sets: KeySet) -> dict[str, Facts]:
    """Rows and NULL rows of several key sets, by one job.

    Sets over the same table are counted in one pass over it (a narrow scan and
    a global aggregate); only two numbers per set come to the driver. Facts are
    literals in the plans that use them, so those hold no subqueries, and a set
    that is empty or holds a NULL leaves no join at all.
    """
    tables: dict[int, list[str]] = {}
    for name, s in sets.items():
        tables.setdefault(id(s.rows), []).append(name)
    parts = []
    for names in tables.values():
        counts, every = [], all(sets[n].where is not None for n in names)
        for n in names:
            s = sets[n]
            inside = F.lit(True) if s.where is None else F.coalesce(s.where, F.lit(False))
            counts.append(F.struct(F.lit(n).alias("name"), F.count_if(inside).alias("rows"), F.count_if(inside & F.col(s.key).isNull()).alias("nulls")))
        rows = sets[names[0]].rows
        if every:  # a filter that the scan can use
            rows = rows.where(reduce(lambda a, b: a | b, [sets[n].where for n in names]))
        parts.append(rows.agg(F.array(*counts).alias("facts")))
    found = reduce(lambda a, b: a.unionByName(b), parts).collect()
    return {f["name"]: Facts(f["rows"], f["nulls"]) for row in found for f in row["facts"]}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _key_column(keyset: DataFrame, key_col) -> Column:
    if key_col is None:
        if len(keyset.columns) != 1:
            raise ValueError("keyset must have exactly one column when key_col is not given")
        key_col = keyset.columns[0]
    return _col(key_col)


def not_in(df: DataFrame, key, keyset: DataFrame, key_col=None, keys_unique: bool = False, facts: Facts | None = None) -> DataFrame:
    """Rows of ``df`` where ``key NOT IN (SELECT key_col FROM keyset)``, with
    SQL's three-valued semantics:

    * set containing a NULL: no row is kept;
    * empty set: every row is kept, NULL keys included;
    * otherwise: rows whose key is not NULL and not in the set.

    Spark's own null-aware anti join always broadcasts the set, whatever its
    size. Here membership is an ordinary anti join with ``=`` (so both sides
    can reuse a partitioning by the key), which the planner runs as a shuffle
    join unless AQE measures the set as small. The keys are folded by a
    partial aggregate first; a set that is unique already (``keys_unique``)
    is joined as it is, so that both inputs are plain shuffles and AQE can
    split a hot key of ``df``.

    The NULL cases are settled by ``facts`` (:func:`set_facts`; one job for all
    sets of a step). Without them the plan stays fully lazy: one one-row scalar
    subquery over the key column alone (a narrow scan) does it, where
    ``count(*)`` is 0 for an empty set, and ``count(*) != count(key)`` when the
    set holds a NULL.
    """
    k = _key_column(keyset, key_col)
    keys = keyset.select(k.alias(_KEY))
    if facts is not None:
        if facts.nulls:
            return df.where(F.lit(False))
        if not facts.rows:
            return df
        keep = _col(key).isNotNull()
    else:
        stats = keys.select(F.struct(F.count(F.lit(1)).alias("n"), F.count(_KEY).alias("nn")).alias("s")).scalar()
        n, nn = stats.getField("n"), stats.getField("nn")
        # One expression on the key (no key-free conjunct that Catalyst could
        # propagate across the join into the key set's plan).
        keep = F.when(n != nn, F.lit(False)).when(_col(key).isNull(), n == 0).otherwise(F.lit(True))
    members = keys if keys_unique else keys.distinct()
    return df.where(keep).join(members, _col(key) == F.col(_KEY), "left_anti")


def exists_flag(df: DataFrame, key, keyset: DataFrame, name: str, key_col=None,
                keys_unique: bool = False) -> DataFrame:
    """Add boolean ``name`` = ``key IN (SELECT key_col FROM keyset)`` for use
    inside a WHERE (where FALSE and NULL both drop the row), e.g.
    ``changed < cutoff OR order_id IN (transfers)``.

    The key set is de-duplicated so the left join cannot repeat rows. When it
    is already unique (``keys_unique``, e.g. the ids of a table keyed by id)
    that aggregate is skipped; both join inputs are then plain shuffles, which
    lets AQE split a partition holding a hot key (skew-join handling does not
    apply when an aggregate sits between a shuffle and the join).
    """
    k = _key_column(keyset, key_col)
    members = keyset.select(k.alias(_KEY)).where(F.col(_KEY).isNotNull())
    if not keys_unique:
        members = members.distinct()
    members = members.withColumn(name, F.lit(True))
    return (df.join(members, _col(key) == F.col(_KEY), "left")
              .withColumn(name, F.coalesce(F.col(name), F.lit(False)))
              .drop(_KEY))


def duplicated_keys(df: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    """``SELECT key FROM df GROUP BY key HAVING count(*) > 1``."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1).select(F.col(key).alias(alias or key)))
