"""Substring deduplication by relative Lempel-Ziv parsing (operator 7).

Each document is cut into reference blocks by content: a window of ``size``
words is ruled by the least hash among its ``GRAM``-word anchors, and the
windows in a row that one anchor rules form a block (the words they cover).
Wherever a passage recurs, its inner blocks recur with it. All blocks are
indexed by anchor and content, with the smallest document that holds them.

A document is then parsed from left to right against that index. A factor takes
block after block as long as a smaller document holds them. Where it ends, the
block at the boundary is not held as a whole, but some of its windows may be:
they are looked up one by one among the windows of the blocks that share its
anchor. Factors of at least ``size`` words, and windows found at boundaries, are
the duplicate spans. A window that recurs has the same anchor in both places, so
none is missed, and blocks are equal if their first and last window are (the two
cover the block).

Texts with equal word sequences are parsed once. Only anchors that two different
texts share travel further than the first count; only blocks at factor
boundaries are opened into windows. Tables are written before they are joined,
so that joins are between plain shuffles, which adaptive execution can split at
a common passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlebook.llm.scratch import Scratch
from settlebook.llm.words import runs, word_hashes

GRAM = 12
LAST = 2**63 - 1  # place of texts without a key in the order of documents
BLOCK = pa.list_(pa.struct([("anchor", pa.int64()), ("head", pa.int64()), ("tail", pa.int64()), ("start", pa.int32()), ("count", pa.int32())]))


def blocks(words: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """anchor, head, tail, start, count of each block of a document."""
    windows = runs(words, size)
    if not len(windows):
        return windows, windows, windows, np.empty(0, np.int32), np.empty(0, np.int32)
    grams = runs(words, GRAM)
    span = size - GRAM + 1
    ruler = np.concatenate([np.lib.stride_tricks.sliding_window_view(grams[i:i + 65536 + span - 1], span).argmin(axis=1)
                            for i in range(0, len(windows), 65536)]) + np.arange(len(windows))
    start = np.flatnonzero(np.diff(ruler, prepend=-1))
    count = np.diff(start, append=len(windows))
    return grams[ruler[start]], windows[start], windows[start + count - 1], start.astype(np.int32), count.astype(np.int32)


def _describe(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """key, th (hash of the text), n, fp (of the word sequence), sha (of all words), blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, fp, sha, cut = [], [], [], []
            for t in batch.column(2).to_pylist():
                data = (t or "").encode()
                words = word_hashes(data)
                n.append(len(words))
                plain = b" ".join(data.split())
                fp.append(hashlib.blake2b(plain, digest_size=16).digest())
                sha.append(hashlib.sha256(plain).hexdigest())
                cut.append(blocks(words, size))
            offsets = np.zeros(len(cut) + 1, np.int32)
            np.cumsum([len(c[0]) for c in cut], out=offsets[1:])
            columns = [pa.array(np.concatenate([c[i] for c in cut] or [np.empty(0)]).astype(kind, copy=False).view(kind) if i > 2
                                else np.concatenate([c[i] for c in cut]).view(np.int64)) for i, kind in
                       enumerate((np.int64, np.int64, np.int64, np.int32, np.int32))]
            entries = pa.StructArray.from_arrays(columns, names=[f.name for f in BLOCK.value_type])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(sha),
                 pa.ListArray.from_arrays(pa.array(offsets), entries)], ["key", "th", "n", "fp", "sha", "blocks"])

    return docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("t")).mapInArrow(
        run, "key long, th long, n long, fp binary, sha string, "
             "blocks array<struct<anchor:long,head:long,tail:long,start:int,count:int>>")


def _windows(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """anchor, window, src, cid, start of every window in the ``wanted`` blocks
    (cid, anchor, start, count, src) of the texts (cid, t)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, src, t, todo in zip(*(batch.column(i).to_pylist() for i in range(4))):
                windows = runs(word_hashes(t.encode()), size)
                at = np.concatenate([np.arange(b["start"], b["start"] + b["count"]) for b in todo])
                anchor = np.repeat([b["anchor"] for b in todo], [b["count"] for b in todo])
                for i in range(0, len(at), 100_000):
                    part = at[i:i + 100_000]
                    m = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor[i:i + m], pa.int64()), pa.array(windows[part].view(np.int64)), pa.array(np.full(m, src)),
                         pa.array(np.full(m, cid)), pa.array(part.astype(np.int32))], ["anchor", "window", "src", "cid", "start"])

    lists = wanted.groupBy("cid", "src").agg(F.collect_list(F.struct("anchor", "start", "count")).alias("todo"))
    return lists.join(texts, "cid").select("cid", "src", "t", "todo").mapInArrow(
        run, "anchor long, window long, src long, cid long, start int")


def _parse(found: DataFrame, size: int) -> DataFrame:
    """cid, spans (word places), n_removed and kept_sha of texts (cid, t) with
    their held windows (start, count), in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, removed, shas = [], [], []
            for t, held in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words, factors = t.encode().split(), []
                for h in held:
                    start, end = h["start"], h["start"] + h["count"] + size - 1
                    if factors and start <= factors[-1]["end"]:  # the factor goes on
                        factors[-1]["end"] = max(factors[-1]["end"], end)
                    else:
                        factors.append({"start": start, "end": end})
                kept, at = [], 0
                for f in factors:
                    kept += words[at:f["start"]]
                    at = f["end"]
                kept += words[at:]
                spans.append(factors)
                removed.append(len(words) - len(kept))
                shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
                                             ["cid", "spans", "n_removed", "kept_sha"])

    return found.select("cid", "t", "held").mapInArrow(
        run, "cid long, spans array<struct<start:int,end:int>>, n_removed long, kept_sha string")


def dedup(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", size: int = 50) -> DataFrame:
    """``<key>, n_words, spans, n_removed, kept_sha256`` per row of ``docs``.

    ``spans`` are the removed stretches of words (start, end exclusive):
    everything that a window of ``size`` words covers which also starts in a
    document with a smaller integer key. Rows that share a key do not remove
    each other's words; a null key counts as larger than all others, and rows
    without a key remove nothing from each other. Null and empty texts have no
    words. Columns that are not named are not read.
    """
    members = scratch.save(_describe(docs, key, text, size), "members")
    long = members.where(F.col("n") >= size)
    rep = F.min(F.struct(F.col("key").isNull().alias("absent"), "key", "th"))
    classes = long.groupBy("fp").agg(rep.alias("rep"), F.first("blocks").alias("blocks"))
    classes = scratch.save(classes.select(F.monotonically_increasing_id().alias("cid"), "fp", F.col("rep.key").alias("key"),
                                          F.col("rep.th").alias("th"), "blocks"), "classes")
    src = F.coalesce("key", F.lit(LAST)).alias("src")
    every = classes.select("cid", src, F.explode("blocks").alias("b")).select("cid", "src", "b.*")
    # anchors in two different texts
    shared = every.groupBy("anchor").agg(F.min("src").alias("low"), F.max("src").alias("high")).where("low < high").select("anchor")
    rows = scratch.save(every.join(scratch.save(shared, "shared"), "anchor", "left_semi"), "rows")
    # the index: each distinct block, with the smallest document that holds it
    block = ["anchor", "head", "tail", "count"]
    index = scratch.save(rows.groupBy(*block).agg(F.min(F.struct("src", "cid", "start")).alias("at")).select(*block, "at.*"), "index")
    anchors = index.groupBy("anchor").agg(F.min("src").alias("low"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    anchors = scratch.save(anchors.select("anchor", "low"), "anchors")
    looked = rows.join(index.select(*block, F.col("src").alias("owner")), block)
    looked = scratch.save(looked.select("cid", "src", "anchor", "start", "count", (F.col("owner") < F.col("src")).alias("whole")), "looked")
    # texts of all blocks that are held, opened or opened against
    edge = looked.where("NOT whole").join(anchors, "anchor").where("low < src").select("cid", "src", "anchor", "start", "count")
    edge = scratch.save(edge, "edge")
    against = scratch.save(index.join(edge.select("anchor").distinct(), "anchor", "left_semi")
                           .select("cid", "src", "anchor", "start", "count"), "against")
    need = looked.where("whole").select("cid").unionByName(edge.select("cid")).unionByName(against.select("cid")).distinct()
    need = need.join(classes.select("cid", F.col("key").alias("_key"), F.col("th").alias("_th")), "cid")
    source = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    texts = source.join(need, (F.col("th") == F.col("_th")) & F.col("key").eqNullSafe(F.col("_key"))).select("cid", "t")
    texts = scratch.save(texts.dropDuplicates(["cid"]), "texts")
    # windows at factor boundaries
    open_windows = _windows(texts, against, size).groupBy("anchor", "window").agg(F.min("src").alias("owner"))
    open_windows = scratch.save(open_windows, "windows")
    seeking = scratch.save(_windows(texts, edge, size), "seeking")
    single = seeking.join(open_windows, ["anchor", "window"]).where("owner < src").select("cid", "start", F.lit(1).alias("count"))
    # the parse
    held = looked.where("whole").select("cid", "start", "count").unionByName(single)
    held = held.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("start", "count"))).alias("held"))
    parsed = scratch.save(_parse(held.join(texts, "cid"), size).join(classes.select("cid", "fp"), "cid").drop("cid"), "parsed")
    firsts = classes.select("fp", F.col("key").alias("first_key")).join(parsed, "fp", "left")
    firsts = scratch.save(firsts, "firsts").withColumnRenamed("fp", "_fp")
    scratch.keep_only("members", "firsts")
    out = members.select("key", "n", "fp", "sha").join(firsts, (F.col("fp") == F.col("_fp")) & (F.col("n") >= size), "left")
    copy = F.col("first_key").isNotNull() & ~F.col("key").eqNullSafe(F.col("first_key"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("end")))
    return out.select(
        F.col("key").alias(key), F.col("n").alias("n_words"), F.when(copy, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"))
