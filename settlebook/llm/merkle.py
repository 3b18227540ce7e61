"""Merkle manifest of a dataset by nested-struct rollup (operator 12).

Every row is a leaf. Per group the leaves, in the order of their ids, are put
together eight by eight until one subroot is left; the groups' subroots are put
together the same way into the root. A leaf's rank gives the path to it: its
octal digits. Within blocks of 8^4 leaves the digits are grouped away one after
the other, each time nesting the children as sorted structs in their parent, so
a block is one row that holds its whole subtree. Explode, from the top down,
turns it into leaves again, and each child takes along its siblings' digests:
proofs need no join within a block. Block roots are the leaves of the next
tier (one table of blocks is joined to the path above them, by block).

A tier has a row per 4096 nodes of the tier below, so no row and no group grows
with the data; the number of tiers is the logarithm of the largest group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlebook.llm.places import places
from settlebook.llm.scratch import Scratch

FAN, DEPTH = 8, 4
BLOCK = FAN**DEPTH
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _part(c) -> Column:
    s = F.col(c).cast("string") if isinstance(c, str) else c
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(columns, text: str = "text", changed: Column | None = None) -> Column:
    """SHA-256 over the columns, each as byte count, colon and value, or ``-`` if
    null; ``changed`` stands in for ``text``."""
    return F.sha2(F.concat(*(_part(changed if changed is not None and c == text else c) for c in columns)), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["digest"]), "")


def _rolled(nodes: DataFrame) -> DataFrame:
    """``g, n, block, digest, kids`` per block of ``nodes`` (g, n, place, digest, load).

    The k-th digit is grouped away if the group has more than 8^(k-1) nodes;
    else the one node there is stays as it is.
    """
    digits = [f"d{k}" for k in range(DEPTH)]
    within = F.pmod("place", F.lit(BLOCK))
    rows = nodes.select("g", "n", (F.col("place") / BLOCK).cast("long").alias("block"), "digest", "load",
                        *(F.pmod(F.floor(within / FAN**k), F.lit(FAN)).cast("int").alias(d) for k, d in enumerate(digits)))
    rows = rows.repartition("g", "block").select("g", "n", "block", *digits[1:], F.struct(F.col("d0").alias("d"), "digest", "load").alias("node"))
    for k in range(DEPTH):
        kids = F.sort_array(F.collect_list("node")).alias("kids")
        rows = rows.groupBy("g", "n", "block", *digits[k + 1:]).agg(kids)
        digest = F.when(F.col("n") > FAN**k, F.sha2(_joined(F.col("kids")), 256)).otherwise(F.col("kids")[0]["digest"])
        rows = rows.withColumn("digest", digest)
        if k + 1 < DEPTH:
            rows = rows.select("g", "n", "block", *digits[k + 2:], F.struct(F.col(digits[k + 1]).alias("d"), "digest", "kids").alias("node"))
    return rows


def _opened(rows: DataFrame, carried: list[str]) -> DataFrame:
    """The nodes of blocks that carry ``proof`` (siblings above, as text) and
    ``path`` (left and right siblings per level above): ``load, digest`` of each,
    with both continued down to it."""
    for k in reversed(range(DEPTH)):
        digests = F.transform("kids", lambda x: x["digest"])

        def with_siblings(kid: Column, i: Column) -> Column:
            left = F.array_join(F.slice(digests, F.lit(1), i), "")
            right = F.array_join(F.slice(digests, i + 2, F.lit(FAN)), "")
            return F.struct(kid.alias("kid"), left.alias("left"), right.alias("right"))

        rows = rows.select("n", "proof", "path", *carried, F.explode(F.transform("kids", with_siblings)).alias("x"))
        step = F.array(F.struct(F.col("x.left").alias("left"), F.col("x.right").alias("right")))
        below = [F.col("x.kid.kids").alias("kids")] if k else [F.col("x.kid.load").alias("load"), F.col("x.kid.digest").alias("digest")]
        rows = rows.select("n", F.concat("x.left", "x.right", "proof").alias("proof"),
                           F.when(F.col("n") > FAN**k, F.concat(step, "path")).otherwise(F.col("path")).alias("path"), *carried, *below)
    return rows.drop("n")


def _tiers(nodes: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """Blocks of ``nodes``, blocks of those blocks' roots, and so on to one block per group."""
    out = []
    while True:
        out.append(scratch.save(_rolled(nodes), f"{name}-tier{len(out)}"))
        if out[-1].where(F.col("n") > BLOCK).isEmpty():
            return out
        nodes = out[-1].select("g", F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("block").alias("place"), "digest",
                               F.col("block").alias("load"))


def _down(tiers: list[DataFrame], top: DataFrame, carried: list[str]) -> DataFrame:
    """The lowest tier's nodes with their proofs; ``top`` has ``g, proof, path`` and ``carried`` per group."""
    above = top.withColumn("block", F.lit(0).cast("long"))
    for tier in reversed(tiers[1:]):
        opened = _opened(tier.select("g", "n", "block", "kids").join(above, ["g", "block"]), ["g", *carried])
        above = opened.withColumnRenamed("load", "block").drop("digest")
    return _opened(tiers[0].select("g", "n", "block", "kids").join(above, ["g", "block"]), carried)


def manifest(docs: DataFrame, scratch: Scratch, key: str = "doc_id", group: str = "lang", text: str = "text",
             columns=("doc_id", "source", "lang", "n_chars", "text"), tampered: Column | None = None) -> DataFrame:
    """``<key>, leaf, subroot, root, proof, path, folded_root, verified`` per row.

    ``proof`` is the text of the siblings' digests from the leaf up to the root,
    ``path`` the same as (left, right) per level, bottom first; ``folded_root`` is
    computed again from the row as it is now, which ``tampered`` rows (by default
    those whose key's crc32 is a multiple of 3) find with their text's A-Z
    lower-cased. ``verified``: it equals the root.

    Null groups are a group of their own, the first; null keys come first and
    are never tampered with; rows that tie in their key follow the order of their
    digests, so repeated rows change nothing but the number of leaves. A group of
    one row is its own subroot, and a single group its own root; an empty table
    gives no rows. Columns beside ``columns`` are not read, whatever their names.
    """
    if tampered is None:
        tampered = F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 0
    changed = F.when(tampered, leaf_digest(columns, text, F.translate(F.col(text), UPPER, LOWER)))
    g = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group)))
    leaves = scratch.save(docs.select(g.alias("g"), F.col(key).alias("id"), leaf_digest(columns).alias("digest"), changed.alias("changed")), "leaves")
    ranked = places(leaves, scratch, "leaves", ["g"], ["id", "digest"])
    tiers = _tiers(ranked.select("g", "n", "place", "digest", F.struct("id", "changed").alias("load")), scratch, "leaf")
    subroots = scratch.save(tiers[-1].select(F.lit("").alias("all"), F.col("g").alias("load"), "digest"), "subroots")
    ranked = places(subroots, scratch, "subroots", ["all"], ["load"])
    over = _tiers(ranked.select(F.col("all").alias("g"), "n", "place", "digest", "load"), scratch, "group")
    start = over[-1].select("g", F.lit("").alias("proof"), F.array().cast("array<struct<left:string,right:string>>").alias("path"),
                            F.col("digest").alias("root"))
    tops = scratch.save(_down(over, start, ["root"]).select(F.col("load").alias("g"), F.col("digest").alias("subroot"), "root", "proof", "path"), "tops")
    found = _down(tiers, tops, ["subroot", "root"])
    folded = F.aggregate("path", F.coalesce("load.changed", "digest"), lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))
    found = found.select(F.col("load.id").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "proof", "path", folded.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
