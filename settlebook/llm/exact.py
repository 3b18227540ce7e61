"""Exact deduplication by deterministic block naming (operator 6).

A normalised text is cut into blocks of fixed size. The distinct blocks are
dealt by hash (so that equal ones meet), sorted within each part, and named by
part and place, an integer each; then adjacent names are paired, the distinct
pairs are dealt, sorted and named likewise, and so on, until every document is
down to one name. Which integer a block gets depends on the number of parts;
which blocks share one does not. Equal names on a level mean equal bytes, by induction, so level and
last name identify a text without collisions.

Blocks travel once, to be sorted. Their names go back to the documents by a
128-bit handle of the block: the distinct blocks are compared in full, and if
two of them shared a handle, the handles would be drawn anew with another seed.
All else moves integers. Every name table is written before it is used, so that
names do not depend on recomputation, and each join is between two plain
shuffles of written tables, which adaptive execution can split where a block
or text is hot. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlebook.llm.scratch import Scratch

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _blocks(data: Column, size: int) -> Column:
    """The blocks of a binary column, an empty array for no bytes."""
    n = F.ceil(F.octet_length(data) / size).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(data, i * size + 1, F.lit(size)))
    return F.when(n > 0, cut).otherwise(F.array().cast("array<binary>"))


def _handle(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(seed), block).alias("h1"), F.xxhash64(F.lit(~seed), block).alias("h2"))


def _named(distinct: DataFrame, by: list[str]) -> DataFrame:
    """Integer names of distinct rows, rising with ``by`` within each partition."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def identify(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", block: int = 1024,
             row: str | None = None) -> DataFrame:
    """``rid, <key>, text_sha256, level, name`` per row of ``docs``; two rows
    have equal (level, name) if and only if their normalised texts are equal.

    ``row`` names a column that identifies rows; without it the operator
    numbers them itself. Null texts count as empty; columns that are not named
    are not read.
    """
    rid = F.col(row) if row else F.monotonically_increasing_id()
    texts = docs.select(rid.alias("rid"), F.col(key).alias("key"), normalised(F.col(text)).alias("t"))
    for seed in range(2**31):
        # the bytes are a column of their own: block expressions would else evaluate them anew for every block
        data = texts.select("rid", "key", F.col("t").cast("binary").alias("d"))
        cut = data.select("rid", "key", F.sha2("d", 256).alias("sha"), _blocks(F.col("d"), block).alias("b"))
        rows = scratch.save(cut.select("rid", "key", "sha", F.transform("b", lambda b: _handle(b, seed)).alias("h")), f"rows{seed}")
        # explode_outer: for explode, Spark infers a filter on the array, pushes it to the scan and so cuts every text there again
        distinct = (data.select(_blocks(F.col("d"), block).alias("b")).select(F.explode_outer("b").alias("block")).where("block IS NOT NULL")
                    .select(_handle(F.col("block"), seed).alias("h"), "block").select("h.h1", "h.h2", "block").distinct())
        names = scratch.save(_named(distinct, ["block"]).drop("block"), f"blocks{seed}")
        if names.groupBy("h1", "h2").count().where("count > 1").isEmpty():
            break
    n = F.size("h")
    level = (rows.where(n > 0).select("rid", n.alias("n"), F.posexplode("h").alias("pos", "h")).select("rid", "n", "pos", "h.h1", "h.h2")
             .join(names, ["h1", "h2"]).select("rid", "n", "pos", "name"))
    level = scratch.save(level, "level0")
    most = rows.agg(F.max(n)).first()[0] or 0
    done = [rows.where(n == 0).select("rid", F.lit(-1).alias("level"), F.lit(0).cast("long").alias("name")),
            level.where("n = 1").select("rid", F.lit(0).alias("level"), "name")]
    for k in range(1, max(most - 1, 0).bit_length() + 1):
        pairs = level.where("n > 1").groupBy("rid", "n", F.expr("pos DIV 2").cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        pairs = scratch.save(pairs.withColumn("n", F.expr("(n + 1) DIV 2").cast("int")), f"pairs{k}")
        names = scratch.save(_named(pairs.select("a", "b").distinct(), ["a", "b"]), f"names{k}")
        level = scratch.save(pairs.join(names, ["a", "b"]).select("rid", "n", "pos", "name"), f"level{k}")
        done.append(level.where("n = 1").select("rid", F.lit(k).alias("level"), "name"))
    last = done[0]
    for d in done[1:]:
        last = last.unionByName(d)
    found = rows.join(last, "rid").select("rid", F.col("key").alias(key), F.col("sha").alias("text_sha256"), "level", "name")
    return scratch.save(found, "identities")


def dedup(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", block: int = 1024,
          row: str | None = None) -> DataFrame:
    """``rid, <key>, keep_id, group_size, kept, text_sha256`` per row of ``docs``.

    Of rows with equal normalised text that with the smallest key stays; a null
    key loses to any other; of rows that repeat the smallest key the first one
    stays. ``keep_id`` is null only if the whole group has null keys. Empty and
    null texts form one group. No rows give no rows.
    """
    found = identify(docs, scratch, key, text, block, row)
    groups = scratch.save(found.groupBy("level", "name").agg(
        F.min(F.struct(F.col(key).isNull().alias("absent"), F.col(key).alias("key"), "rid")).alias("first"),
        F.count(F.lit(1)).alias("group_size")), "groups")
    scratch.keep_only("identities", "groups")
    groups = groups.select("level", "name", F.col("first.key").alias("keep_id"), F.col("first.rid").alias("_rid"), "group_size")
    return found.join(groups, ["level", "name"]).select(
        "rid", key, "keep_id", "group_size", (F.col("rid") == F.col("_rid")).alias("kept"), "text_sha256")
