"""Mixing sources to target weights by systematic sampling (operator 13).

A document's size is its number of words. Targets share the total size by
weight; a source's target stops at three times its size, and what it leaves is
shared again. Within a source documents stand in the order of their sizes,
greatest first; each has a number of expected copies, their prefix sum plus one
random offset per source runs along the documents, and a document is emitted
once for each integer that the sum passes at it.

Expected copies are what is still missing of the target over the size still to
come, the same for all documents of one size. So what rounding a long document
leaves over or short is made good by the shorter ones, and the taken words end
within about one short document of the target. This needs only the number of
documents per source and size; places within those are counted over ranges, so
neither a hot source nor a hot size meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlebook.llm.places import places
from settlebook.llm.scratch import Scratch

UNIT = 1 << 20  # an expected copy in the units of the sums, which are whole numbers
MOST = 3  # copies of a document


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """``sizes`` (s, source_size, place: the source's place in the order that
    gives weights) with ``target``.

    The sources that stop at three times their size are those below a common
    level per unit of weight; the level rises with each round of sharing until
    no further source is passed. A round sends two sums to the driver.
    """
    sizes = sizes.withColumn("w", F.element_at(F.array(*(F.lit(int(w)) for w in weights)), F.pmod("place", F.lit(len(weights))).cast("int") + 1))
    size, w = F.col("source_size").cast("decimal(38,0)"), F.col("w")
    left, over = sizes.agg(F.sum(size), F.sum(w.cast("decimal(38,0)"))).first()
    total = left
    stops = F.lit(False)
    while over:
        stops = size * F.lit(MOST * int(over)).cast("decimal(19,0)") < w * F.lit(int(left)).cast("decimal(19,0)")
        new = sizes.agg(F.sum(F.when(stops, size * MOST)), F.sum(F.when(~stops, w.cast("decimal(38,0)")))).first()
        after = (total - (new[0] or 0), new[1] or 0)
        if after == (left, over):
            break
        left, over = after
    share = F.col("w").cast("double") * F.lit(float(left or 0)) / F.lit(float(over or 1))
    return sizes.withColumn("target", F.when(stops, (MOST * F.col("source_size")).cast("double")).otherwise(share)).drop("w")


def _rates(levels: pd.DataFrame) -> pd.DataFrame:
    """One source's sizes with the expected copies of their documents (``rate``)
    and the prefix sum before the first of them (``before``)."""
    levels = levels.sort_values("size", ascending=False)
    goal, offset = int(levels["goal"].iloc[0]), int(levels["offset"].iloc[0])
    left = int((levels["size"] * levels["m"]).sum())
    at, taken, rates, before = 0, 0, [], []
    for size, m in zip(levels["size"].tolist(), levels["m"].tolist()):
        rate = min(MOST * UNIT, max(0, goal - taken) * UNIT // left) if left else 0
        rates.append(rate)
        before.append(at + offset)
        emitted = (at + offset + m * rate) // UNIT - (at + offset) // UNIT
        at, taken, left = at + m * rate, taken + emitted * size, left - m * size
    return pd.DataFrame({"s": levels["s"], "size": levels["size"], "rate": rates, "before": before})


def mix(docs: DataFrame, scratch: Scratch, weights: Sequence[int] = (5, 2, 1), seed: str = "mix", key: str = "doc_id",
        text: str = "text", source: str = "source") -> DataFrame:
    """``<key>, size, source_size, target, copies, taken`` per row.

    Sources in code-point order, null last, take the weights in turn. Null and
    empty texts have size 0 and are not taken; a corpus without words has targets
    of 0. Rows that tie in size follow the order of their keys (nulls first);
    repeated rows are documents of their own. The offset depends on ``seed`` and
    the source alone, so reruns agree. Columns that are not named are not read.
    """
    s = F.when(F.col(source).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source)))
    slim = scratch.save(docs.select(F.col(key).alias("id"), s.alias("s"), n_words(text).alias("size")), "sizes")
    ranked = scratch.save(places(slim, scratch, "documents", ["s", "size"], ["id"], total="m"), "placed")
    levels = ranked.where("place = 0").select("s", "size", "m")
    sums = scratch.save(levels.groupBy("s").agg(F.sum(F.col("size") * F.col("m")).alias("source_size")).withColumn("all", F.lit(0)), "sums")
    ordered = scratch.save(places(sums, scratch, "sources", ["all"], ["s"]).drop("all", "n"), "ordered")
    goals = scratch.save(targets(ordered, weights).drop("place"), "targets")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("s"))), 1, 5), 16, 10).cast("long")
    drawn = levels.join(goals.select("s", F.floor(F.col("target") + 0.5).alias("goal"), offset.alias("offset")), "s")
    rates = drawn.groupBy("s").applyInPandas(_rates, "s string, size long, rate long, before long")
    plan = scratch.save(rates.join(goals, "s"), "rates")
    # Keyed by source, size and a bounded stretch of places, so that a hot size is many keys.
    stretch = F.floor(F.col("place") / 65536)
    keyed = ranked.withColumn("stretch", stretch)
    spread = plan.join(levels, ["s", "size"]).withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / 65536)))).drop("m")
    found = keyed.join(spread, ["s", "size", "stretch"])

    copies = F.expr(f"(before + (place + 1) * rate) div {UNIT} - (before + place * rate) div {UNIT}").cast("long")
    return found.select(F.col("id").alias(key), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
