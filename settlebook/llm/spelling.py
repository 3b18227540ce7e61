"""Spelling variant grouping along the frontier of a relational trie (operator 11).

Words are the rows of a trie kept as an edge table: an edge leads from a node
(its path as text) by the first character of its label to the longest prefix
that all words below share, or to a single word. It is built from the root
down, all nodes of a level at once. The frontier is a table of states (word,
rest, node, edits): a word goes along its own path without edits; at each node
where it could part from a neighbour it leaves with one edit, a replaced
character (another edge) or a dropped one (the same node, a character further);
from then on a state lives only as long as an edge continues it exactly. A
state that ends at a word has found a neighbour.

Two words with one edit between them share either the half in front of it or
the half behind it. So there are two tries, of the words and of the reversed
words, and edits are made in the latter half of each only: all nodes near the
roots, where everything branches, are passed without an edit, and each
pair is found once. Of two words of one length the one with the smaller
character at the edit finds the other; of two lengths the longer one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlebook.llm.scratch import Scratch

RUN = "[A-Za-zÀ-ÿ]+"
LEAST, TIMES, EVERY, RATIO = 5, 3, 97, 2
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
START = 2  # characters in front of any edit: half of the shortest word
SLICE, HELD = 1 << 20, 200_000


def runs_of(text: str) -> Iterator[list[str]]:
    """The lower-cased runs of a text, by slices of about a million characters."""
    stop, at = re.compile("[^A-Za-zÀ-ÿ]"), 0
    find = re.compile(RUN).findall
    while at < len(text):
        cut = stop.search(text, at + SLICE)
        end = cut.start() if cut else len(text)
        yield find(text[at:end].translate(LOWERED))
        at = end


def altered(key: str, run: str, every: int = EVERY) -> str:
    """The run, without one character if its document and it are chosen by their checksum."""
    h = zlib.crc32(f"{key}:{run}".encode())
    return run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, every: int = EVERY) -> DataFrame:
    """``word, n``: partial counts of words of at least ``least`` characters. A
    task holds at most ``HELD`` words between two outputs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                prefix, own = zlib.crc32(f"{k or ''}:".encode()), Counter()
                for found in runs_of(t.as_py() or ""):
                    own.update(found)
                for word, n in own.items():
                    if len(word) >= least:
                        h = zlib.crc32(word.encode(), prefix)
                        if not h % every:
                            h %= len(word)
                            word = word[:h] + word[h + 1:]
                            if len(word) < least:
                                continue
                        held[word] += n
                if len(held) > HELD:
                    yield out()
        if held:
            yield out()

    return docs.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).mapInArrow(run, "word string, n long")


def _shared(a: Column, b: Column) -> Column:
    """Length of the common prefix of two texts, by halving."""
    def longer(k: Column, step: Column) -> Column:
        to = k + step
        return F.when((to <= F.least(F.length(a), F.length(b))) & (F.substring(a, F.lit(1), to) == F.substring(b, F.lit(1), to)), to).otherwise(k)

    steps = F.array(*(F.lit(1 << s) for s in range(30, -1, -1)))
    return F.aggregate(steps, F.lit(0), longer)


def _rest(c: Column, at: Column) -> Column:
    """What follows the first ``at`` characters."""
    return F.substring(c, at + 1, F.length(c))


def trie(words: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Edges and paths of the tries of ``words`` (way, word, n), ``way`` naming the trie.

    Edges: ``way, node, first, label, to, leaf, n, shortest, longest, next`` --
    ``first`` is empty where a word ends at the node, ``next`` holds the first
    characters of the edges of ``to``, with a full stop if a word ends there.
    Paths: ``way, word, n, node`` for every node that a word passes.
    """
    live = scratch.save(words.withColumn("node", F.substring("word", 1, START)), "live0")
    paths, edges, level = [live], [], 0
    while True:
        at = F.length("node")
        groups = live.withColumn("first", F.substring(F.col("word"), at + 1, F.lit(1))).groupBy("way", "node", "first").agg(
            F.count(F.lit(1)).alias("m"), F.min("word").alias("lo"), F.max("word").alias("hi"), F.max("n").alias("n"),
            F.min(F.length("word")).alias("shortest"), F.max(F.length("word")).alias("longest"))
        leaf = F.col("m") == 1
        to = F.when(leaf, F.col("lo")).otherwise(F.substring(F.col("lo"), F.lit(1), _shared(F.col("lo"), F.col("hi"))))
        found = scratch.save(groups.select("way", "node", "first", to.alias("to"), leaf.alias("leaf"), "n", "shortest", "longest"), f"edges{level}")
        edges.append(found)
        inner = found.where(~F.col("leaf")).select("way", "node", "first", "to")
        if inner.isEmpty():
            break
        level += 1
        live = live.withColumn("first", F.substring(F.col("word"), at + 1, F.lit(1))).join(inner, ["way", "node", "first"])
        live = scratch.save(live.select("way", "word", "n", F.col("to").alias("node")), f"live{level}")
        paths.append(live)
    every = edges[0]
    for e in edges[1:]:
        every = every.unionByName(e)
    branches = every.groupBy("way", F.col("node").alias("to")).agg(
        F.array_join(F.collect_set(F.when(F.col("first") == "", ".").otherwise(F.col("first"))), "").alias("next"))
    label = _rest(F.col("to"), F.length("node"))
    every = scratch.save(every.withColumn("label", label).join(branches, ["way", "to"], "left").select(
        "way", "node", "first", "label", "to", "leaf", "n", "shortest", "longest", F.coalesce("next", F.lit("")).alias("next")), "edges")
    passed = paths[0]
    for p in paths[1:]:
        passed = passed.unionByName(p)
    return every, passed


def _first(c: Column) -> Column:
    return F.substring(c, 1, 1)


def _goes_on(rest: Column) -> Column:
    """Whether the edge's target has an edge for the rest's first character, or a word that ends where the rest does."""
    return F.instr(F.col("next"), F.when(rest == "", ".").otherwise(_first(rest))) > 0


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, n, other, other_n`` for each pair of ``words`` (word, n; distinct,
    of at least four characters) that differ by one inserted, deleted or replaced
    character; each pair once."""
    both = words.select(F.lit(0).alias("way"), "word", "n").unionByName(words.select(F.lit(1).alias("way"), F.reverse("word").alias("word"), "n"))
    edges, paths = trie(both, scratch)
    size, at = F.length("word"), F.length("node")
    half = F.floor(size / 2).cast("int")
    least = F.when(F.col("way") == 0, half).otherwise(size - half)
    here = paths.where((at >= least) & (at < size)).withColumn("rest", _rest(F.col("word"), at))
    own, after = _first(F.col("rest")), _rest(F.col("rest"), F.lit(1))
    # Replaced: by an edge with a greater first character, whose label's tail the word continues.
    tail = _rest(F.col("label"), F.lit(1))
    taken = F.substring(after, F.lit(1), F.length("label") - 1)
    left = F.substring(after, F.length("label"), size)
    hits = (F.col("first") > own) & (taken == tail) & size.between(F.col("shortest"), F.col("longest")) & F.when(
        F.col("leaf"), left == "").otherwise(_goes_on(left))
    replaced = here.join(edges.withColumnRenamed("n", "to_n"), ["way", "node"]).where(hits).select(
        "way", "word", "n", F.col("to").alias("node"), left.alias("rest"), "leaf", F.col("to_n").alias("other_n"))
    # Dropped: the last of equal characters; in the reversed trie only where those end before the half.
    run = F.substring(F.col("word"), size - half, at - (size - half) + 2)
    in_front = (F.col("way") == 1) & (run == F.repeat(own, at - (size - half) + 2))
    dropped = here.where((own != _first(after)) & ~in_front).select(
        "way", "word", "n", "node", after.alias("rest"), (size - 1).alias("aim"))
    replaced = scratch.save(replaced, "replaced")
    done = [replaced.where("leaf").select("way", "word", "n", F.col("node").alias("other"), "other_n")]
    states = replaced.where(~F.col("leaf")).select("way", "word", "n", "node", "rest", size.alias("aim")).unionByName(dropped)
    step = 0
    while True:
        step += 1
        left = _rest(F.col("rest"), F.length("label"))
        fits = (F.substring(F.col("rest"), F.lit(1), F.length("label")) == F.col("label")) & F.when(
            F.col("leaf"), left == "").otherwise(_goes_on(left)) & F.col("aim").between(F.col("shortest"), F.col("longest"))
        moved = states.withColumn("first", _first(F.col("rest"))).join(edges.withColumnRenamed("n", "to_n"), ["way", "node", "first"]).where(fits)
        moved = scratch.save(moved.select("way", "word", "n", F.col("to").alias("node"), left.alias("rest"), "aim", "leaf",
                                          F.col("to_n").alias("other_n")), f"states{step}")
        done.append(moved.where("leaf").select("way", "word", "n", F.col("node").alias("other"), "other_n"))
        states = moved.where(~F.col("leaf")).drop("leaf", "other_n")
        if states.isEmpty():
            break
    found = done[0]
    for d in done[1:]:
        found = found.unionByName(d)
    forward = F.col("way") == 0
    return scratch.save(found.select(F.when(forward, F.col("word")).otherwise(F.reverse("word")).alias("word"), "n",
                                     F.when(forward, F.col("other")).otherwise(F.reverse("other")).alias("other"), "other_n"), "pairs")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` by doubling pointers along ``forms`` (word, form), whose chains end."""
    up = forms.select("word", F.col("form").alias("root"))
    for k in range(64):
        over = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        up = scratch.save(up.join(over, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
                          f"roots{k}")
        if up.where("moved").isEmpty():
            break
        up = up.drop("moved")
    return up.select("word", "root")


def group(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES,
          every: int = EVERY, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per distinct word of the corpus with
    at least ``least`` characters and ``times`` occurrences.

    ``least`` is 4 or more: the tries start behind two characters, which no edit
    may touch. Null and empty texts have no words; a null key is an empty text in
    the checksum; repeated rows count again. Of near words of equal count the
    first in code-point order is the form. Columns that are not named are not read.
    """
    if least < 2 * START:
        raise ValueError(f"words of under {2 * START} characters cannot be compared")
    words = scratch.save(counted(docs, key, text, least, every).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times), "words")
    pairs = near_words(words, scratch)
    there = pairs.select("word", F.col("other").alias("near"), F.col("other_n").alias("near_n"))
    back = pairs.select(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = there.unionByName(back).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    formed = words.join(best, "word", "left")
    has = -F.col("best.minus") >= ratio * F.col("n")
    formed = scratch.save(formed.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                        F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.minus")).alias("form_n")), "formed")
    roots = _roots(formed.where(F.col("form").isNotNull()), scratch)
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
