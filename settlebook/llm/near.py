"""MinHash near-deduplication by an LSH forest (operator 1).

Texts with equal shingle sets form a class, and classes are compared. A class
has a signature of ``HASHES`` minima; a tree of the forest is the order of all
classes by the signature read from another starting point on. Classes that
agree on the first ``DEPTH`` values of an order share a region of that tree.

1. Neighbours: each order is sorted over all machines; neighbours are candidates
   if their common prefix reaches ``DEPTH``. The neighbour with the longest one
   in any tree is confirmed first. This ties dense groups of near copies
   together with about one comparison a class.
2. Regions: a region that lies in one component needs nothing more. Of others,
   regions of at most ``REGION`` classes give all pairs across components;
   larger ones are split by the next values of the order until they are small
   or of one component (the depth adapts to each region). The splits tie most
   of a large region together, but part pairs.
3. Crowds: the classes of large regions that several components still share
   are joined exactly, by the rarest shingles of their sets.

Candidates are confirmed on the full shingle sets of the texts. Two classes of
similarity s miss each other in all trees with probability (1 - s^DEPTH)^TREES
(below 3e-5 at 0.8), in regions of any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settlebook.llm.components import components
from settlebook.llm.scratch import Scratch
from settlebook.llm.words import shingles
from settlebook.operators.split import split_by_keys

HASHES, TREES, DEPTH, REGION = 120, 20, 4, 32
STEP = HASHES // TREES
DEPTHS = (4, 5, 6, 8, 10, 13, 16, 20, 25, 32, 40, 50, 64, 80, 100, 120)
SORTED = 12  # values of an order that are sorted
ROWS = 1 << 17  # shingles handed over at once


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return (rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1)), rng.integers(0, 2**32, n, dtype=np.uint32)


def signature(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    low = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    x = (found >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(low, (x[i:i + 2048, None] * a + b).min(axis=0), out=low)
    return low.astype(">u4").tobytes()


def _describe(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """key, th (hash of the text), n, fp (identity of the set, null if empty), sig."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _multipliers(HASHES)
        for batch in batches:
            n, fp, sig = [], [], []
            for t in batch.column(2).to_pylist():
                found = shingles((t or "").encode().lower(), size)
                n.append(len(found))
                fp.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                sig.append(signature(found, a, b) if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(fp, pa.binary()),
                                              pa.array(sig, pa.binary())], ["key", "th", "n", "fp", "sig"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("t")).mapInArrow(
        run, f"key {kind}, th long, n long, fp binary, sig binary")


def _neighbours(rows: DataFrame) -> DataFrame:
    """a, b, same: neighbours in each sorted order and the length of their common prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, order, cid = -1, b"", -1
        for batch in batches:
            a, b, same = [], [], []
            for t, o, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if t == tree and o[:4 * DEPTH] == order[:4 * DEPTH]:
                    k = DEPTH
                    while k < SORTED and o[4 * k:4 * k + 4] == order[4 * k:4 * k + 4]:
                        k += 1
                    a.append(cid)
                    b.append(c)
                    same.append(k)
                tree, order, cid = t, o, c
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(same, pa.int32())],
                                             ["a", "b", "same"])

    ordered = rows.repartitionByRange("tree", "order", "cid").sortWithinPartitions("tree", "order", "cid")
    return ordered.select("tree", "order", "cid").mapInArrow(run, "a long, b long, same int")


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                s, t = shingles(s.encode().lower(), size), shingles(t.encode().lower(), size)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, k in zip(a, keep) if k], pa.int64()),
                                              pa.array([x for x, k in zip(b, keep) if k], pa.int64())], ["a", "b"])

    ta, tb = (texts.select(F.col("cid").alias(c), F.col("t").alias(f"t{c}")) for c in "ab")
    return pairs.select("a", "b").join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """cid, token, n: a row per shingle, with the size of its set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            n = np.array([len(s) for s in sets], dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(ids, dtype=np.int64), n)), pa.array(np.concatenate(sets).view(np.int64)),
                                               pa.array(np.repeat(n, n))], ["cid", "token", "n"])

        for batch in batches:
            ids, sets, held = [], [], 0
            for c, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(c)
                sets.append(shingles(t.encode().lower(), size))
                held += len(sets[-1])
                if held >= ROWS:
                    yield rows()
                    ids, sets, held = [], [], 0
            if sets:
                yield rows()

    return texts.select("cid", "t").mapInArrow(run, "cid long, token long, n long")


def _crowds(classes: DataFrame, texts: DataFrame, scratch: Scratch, size: int, percent: int) -> DataFrame:
    """a, b: candidates of different components (``cid, root``) by an exact prefix filter.

    A set's shingles are placed from the rarest to the commonest. Sets of x <= y
    shingles that reach ``percent`` have p (x + y) / (100 + p) in common or more,
    so the first they share stands early in both: its place leaves at least as
    many in either. In the smaller set that is the first ninth at 80, in the
    larger the first fifth. Shingles that a family has in common come last.
    """
    sets = scratch.save(_sets(classes.select("cid").join(texts, "cid"), size), "sets")
    times = scratch.save(sets.groupBy("token").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "times")
    own = Window.partitionBy("cid")  # shingles of one set only come first and need no rows
    place = F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("times", "token"))
    rows = sets.join(times, "token").select("cid", "token", "n", place.alias("place")).where(100 * (F.col("n") - F.col("place") + 1) >= percent * F.col("n"))
    rows = scratch.save(rows.join(classes, "cid"), "prefixes")
    # a token's commonest component meets only the others, never itself
    of_root = rows.groupBy("token", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("token").agg(
        F.max(F.struct("c", "root")).alias("m"), F.count(F.lit(1)).alias("roots"))
    tops = scratch.save(of_root.where("roots > 1").select("token", F.col("m.root").alias("top")), "tops")
    rows = scratch.save(rows.join(tops, "token").withColumn("most", F.col("root") == F.col("top")).drop("top"), "shared")
    short = rows.where((100 + percent) * (F.col("n") - F.col("place") + 1) >= 2 * percent * F.col("n"))
    short = short.select(F.col("token").alias("ta"), F.col("cid").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"), F.col("place").alias("pa"),
                         F.explode(F.when(F.col("most"), F.array(F.lit(1))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("part"))
    long = rows.select(F.col("token").alias("tb"), F.col("cid").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"), F.col("place").alias("pb"),
                       F.when(F.col("most"), 0).otherwise(1).alias("side"))
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    left = 1 + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    enough = (100 + percent) * left >= percent * (F.col("na") + F.col("nb"))
    pairs = short.join(long, (F.col("ta") == F.col("tb")) & (F.col("part") == F.col("side")) & (F.col("ra") != F.col("rb")) & smaller & enough)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 80) -> DataFrame:
    """``<key>, th, n_shingles, component_id, kept`` per row of ``docs``.

    Words are lower-cased (A to Z); a document's set holds its distinct
    ``size``-word shingles, or its whole word sequence if it is shorter. Sets
    with ``percent`` of their union in common are linked; ``component_id`` is
    the least key that links reach. Documents without words are linked with
    nothing. Null keys never name a component: if all of a component are null,
    so is its id. ``kept`` says that the key is the component's, so repeated
    rows of the least key all stay. ``th`` is xxhash64 of the text. Columns
    that are not named are not read.
    """
    members = scratch.save(_describe(docs, key, text, size), "members")
    first = F.min(F.struct(F.col("key").isNull().alias("absent"), "key", "th"))
    classes = members.where("n > 0").groupBy("fp").agg(first.alias("rep"), F.min("key").alias("least"), F.first("sig").alias("sig"))
    classes = scratch.save(classes.select(F.monotonically_increasing_id().alias("cid"), "fp", F.col("rep.key").alias("key"),
                                          F.col("rep.th").alias("th"), "least", "sig"), "classes")
    # regions of at least two classes, in every tree
    order = F.substring(F.concat("sig", "sig"), F.col("tree") * (4 * STEP) + 1, F.lit(4 * HASHES))
    trees = classes.select("cid", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = trees.select("tree", "cid", F.substring(order, 1, 4 * SORTED).alias("order"))
    rows = rows.withColumn("region", F.xxhash64("tree", F.substring("order", 1, 4 * DEPTH)))
    regions = scratch.save(rows.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("region"), "regions")
    # most rows, signatures and texts are of no shared region: a bitmap keeps them out of the shuffles
    rows = split_by_keys(rows, "region", regions, "region")[1]
    rows = scratch.save(rows.join(regions, "region", "left_semi"), "rows")
    # the classes that may be linked, and their texts
    cids = scratch.save(rows.select("cid").distinct(), "cids")
    shared = split_by_keys(classes.select("cid", "key", "th", "sig"), "cid", cids, "cid")[1]
    shared = scratch.save(shared.join(cids, "cid"), "classes_shared")
    wanted = shared.select("cid", F.col("key").alias("_key"), F.col("th").alias("_th"))
    source = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    texts = split_by_keys(source, "th", wanted, "_th")[1].join(wanted, (F.col("th") == F.col("_th")) & F.col("key").eqNullSafe(F.col("_key"))).select("cid", "t")
    texts = scratch.save(texts.dropDuplicates(["cid"]), "texts")
    # 1. the nearest neighbour of every class
    near = scratch.save(_neighbours(rows), "near")
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "same"))
    best = both.groupBy("a").agg(F.max(F.struct("same", F.col("b").alias("b"))).alias("m")).select("a", F.col("m.b").alias("b"))
    best = scratch.save(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "best")
    links = scratch.save(_confirm(best, texts, size, percent), "links0")
    roots = components(links, scratch, "c0")
    # 2. regions that several components share
    found = None
    live = rows.select("tree", "cid", "region").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    live = live.select("tree", "cid", "region", F.coalesce("root", "cid").alias("root"))
    for k, depth in enumerate(DEPTHS):
        live = scratch.save(live, f"live{k}")
        sizes = live.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        mixed = scratch.save(sizes.where("low <> high").select("region", "n"), f"mixed{k}")
        last = depth == DEPTHS[-1]
        few = live.join(mixed.where(f"n <= {REGION}").select("region"), "region")
        each = few.groupBy("region").agg(F.array_sort(F.collect_list(F.struct("cid", "root"))).alias("g"))
        pairs = each.select("g", F.explode("g").alias("x")).select("x", F.explode(F.filter("g", lambda y: y.cid > F.col("x.cid"))).alias("y"))
        pairs = pairs.where("x.root <> y.root").select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b"))
        if last:  # equal signatures throughout: neighbours by id stand for the rest
            many = live.join(mixed.where(f"n > {REGION}").select("region"), "region").select(
                F.lit(0).alias("tree"), F.concat(F.col("region").cast("string"), F.lit(" " * 4 * SORTED)).cast("binary").alias("order"), "cid")
            pairs = pairs.unionByName(_neighbours(many).select("a", "b"))
        pairs = scratch.save(pairs.distinct(), f"pairs{k}")
        found = pairs if found is None else found.unionByName(pairs)
        many = mixed.where(f"n > {REGION}").select("region")
        if last or many.isEmpty():
            break
        live = live.join(many, "region", "left_semi").join(shared.select("cid", "sig"), "cid")
        live = live.select("tree", "cid", F.xxhash64("tree", F.substring(order, F.lit(1), F.lit(4 * DEPTHS[k + 1]))).alias("region"), "root")
    tested = best.select("a", "b")
    more = scratch.save(_confirm(found.distinct().join(tested, ["a", "b"], "left_anti"), texts, size, percent), "links1")
    links = links.unionByName(more)
    roots = components(links, scratch, "c1")
    # 3. large regions that several components still share
    if k:
        live = rows.select("cid", "region").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
        live = scratch.save(live.select("cid", "region", F.coalesce("root", "cid").alias("root")), "live")
        sizes = live.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        mixed = scratch.save(sizes.where(f"low <> high AND n > {REGION}").select("region"), "mixed")
        crowd = scratch.save(live.join(mixed, "region", "left_semi").select("cid", "root").distinct(), "crowd")
        if not crowd.isEmpty():
            pairs = scratch.save(_crowds(crowd, texts, scratch, size, percent), "pairs")
            tested = tested.unionByName(found)
            more = scratch.save(_confirm(pairs.join(tested, ["a", "b"], "left_anti"), texts, size, percent), "links2")
            roots = components(links.unionByName(more), scratch, "c2")
    # the least key of each component, for each class and row
    of_class = classes.select("cid", "fp", "least").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    of_class = scratch.save(of_class.select("fp", "least", F.coalesce("root", "cid").alias("root")), "roots")
    ids = scratch.save(of_class.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    of_class = scratch.save(of_class.join(ids, "root").select("fp", "component_id"), "component")
    scratch.keep_only("members", "component")
    out = members.select("key", "th", "n", "fp").join(of_class, "fp", "left")
    alone = F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component_id"))
    return out.select(F.col("key").alias(key), "th", F.col("n").alias("n_shingles"), alone.alias("component_id"),
                      F.col("key").eqNullSafe(alone).alias("kept"))
