"""Incremental as-of state: the newest qualifying version per key, carried on.

A monthly close needs, per key, the newest version of a log before its cutoff.
Folding the whole log each month reads years to learn what one month changed.
The fold is a maximum over (order, payload), so it can be carried on: the state of
the last close, merged with the rows that it had not seen or had not yet let in.

Those are (a) all rows of files that came since, whatever their time (late rows
count), and (b) rows of files seen before whose time lies between the old and
the new cutoff. Reading a row twice changes nothing. If a file that was seen is
gone (a compaction, a correction), the state is void and the whole log is folded.

A row must qualify at a later cutoff if it did at an earlier one; what it says
otherwise (status, amounts) is judged by the caller after the fold, so a version
that ends a key's standing is in the state like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlebook.functions.timez import at_or_after, before, day_of
from settlebook.operators.latest import newest

STATE = "_state"


def fold(rows: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """``keys`` and the newest row per key as one struct (``_state``)."""
    return rows.groupBy(*keys).agg(newest(order, payload).alias(STATE))


def merged(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """States over parts of a log, as the state over all of it: the greater struct
    per key. Partial, so a key is one row of each part before the shuffle."""
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    return every.groupBy(*keys).agg(F.max(STATE).alias(STATE))


def unfolded(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    return state.select(*keys, f"{STATE}.*")


@dataclass(frozen=True)
class Seen:
    """What a state was folded from."""
    cutoff: str
    files: tuple[str, ...]


def carried_on(log: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str], cutoff: str,
               former: tuple[DataFrame, Seen] | None = None, qualifies: Callable[[str], Column] | None = None,
               time: str = "changed", read: Callable[[list[str]], DataFrame] | None = None) -> tuple[DataFrame, Seen, str]:
    """The state of ``log`` before ``cutoff``, what it was folded from, and how
    (``whole`` or ``delta``).

    ``qualifies(cutoff)`` is the rule beyond ``time < cutoff``. ``read(files)``
    reads some of the log's files as ``log`` is read. Without a former state, if
    one of its files is gone, or if its cutoff lies after this one, all is folded.
    """
    files = tuple(sorted(log.inputFiles()))
    day = day_of(log, time)

    def kept(rows: DataFrame, bound: Column) -> DataFrame:
        return rows.where(bound & qualifies(cutoff) if qualifies else bound)

    def whole() -> DataFrame:
        return fold(kept(log, before(time, cutoff, day)), keys, order, payload)

    if former is None or read is None or not set(former[1].files) <= set(files) or former[1].cutoff > cutoff:
        return whole(), Seen(cutoff, files), "whole"
    state, seen = former
    parts, fresh = [state], sorted(set(files) - set(seen.files))
    if fresh:
        parts.append(fold(kept(read(fresh), before(time, cutoff, day)), keys, order, payload))
    if seen.cutoff < cutoff and seen.files:
        parts.append(fold(kept(read(list(seen.files)), at_or_after(time, seen.cutoff, day) & before(time, cutoff, day)), keys, order, payload))
    return merged(parts, keys), Seen(cutoff, files), "delta"
