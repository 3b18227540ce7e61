"""Best-fit packing by patterns (operator 9).

Packing depends on lengths alone, and there are at most ``capacity`` of them.
So the corpus is reduced to a histogram of piece lengths (at most ``capacity``
rows, whatever the input), the driver solves the packing on that histogram, and
the solution goes back to the pieces by their rank within their length:

1. patterns: for each length, sets of lengths that fill a sequence together with
   it, in families (of the most plentiful lengths, of few pieces, of even ones)
   of which the one with the best solution is taken;
2. non-negative least squares fits how often each pattern repeats, so that the
   lengths used match the histogram;
3. counts are rounded down to what the histogram holds;
4. steps 1 to 3 again on what is left, as long as they place a good part of it;
5. the rest is packed best-fit, longest first, still on counts.

A solution is a list of runs: "of length l, ranks a to b go to sequences s, s+1,
... at offset o". A piece's rank is its row number in a bucket of its length
plus the sizes of the buckets before; a common length is dealt over many
buckets, so no task holds a whole length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import groupby
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settlebook.llm.chunks import ChunkEncoder
from settlebook.llm.scratch import Scratch

_ENCODERS: dict[str, ChunkEncoder] = {}
# Fixed value: how the byte-level pre-tokenizer of the tokenizers library cuts texts.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 for itself, the others in order for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks_of(path: str) -> dict[bytes, int] | None:
    """Ids by token bytes, if the file is plain byte-level BPE whose merges come in
    the order of their ids: then merging by lowest id is merging by the file's
    rules, and the faster of the two libraries gives the same ids. Else None."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    if (model.get("type", "BPE") != "BPE" or spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space")
            or not cut.get("use_regex", True) or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("dropout")):
        return None
    byte_of, vocab = _byte_of(), model["vocab"]
    merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    if None in merged or merged != sorted(merged):
        return None
    special = {t["content"] for t in spec.get("added_tokens", ())}
    made = [t for t in vocab if t not in special]
    if any(c not in byte_of for t in made for c in t) or len(made) != len(merged) + 256:
        return None
    return {bytes(byte_of[c] for c in t): vocab[t] for t in made}


def _encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        ranks = ranks_of(path)
        if ranks:
            from tiktoken import Encoding
            ids_of = Encoding(path, pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

            def encode(pieces: list[str]) -> list[bytes]:
                return [pack_ids("<%dI" % len(ids), *ids) for ids in map(ids_of, pieces)]
        else:
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(path)
            tok.encode_special_tokens = True  # their strings in a text are ordinary text

            def encode(pieces: list[str]) -> list[bytes]:
                return [pack_ids("<%dI" % len(ids), *ids) for ids in
                        (e.ids for e in tok.encode_batch_fast(pieces, add_special_tokens=False))]

        _ENCODERS[path] = ChunkEncoder(encode)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, path: str, capacity: int = 2048, key: str = "doc_id", text: str = "text",
                 keep_ids: bool = False) -> DataFrame:
    """Ids of each whole text and a final 0, cut into pieces of ``capacity``
    ids, of which the first may be shorter.

    Returns ``key, piece, start, length, ids_crc32`` (and ``ids`` with
    ``keep_ids``); a null or empty text is one piece of length 1. Null and
    repeated keys pass through, a row's pieces for each row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path)
        for batch in batches:
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, b in enumerate(enc(t or "" for t in batch.column(1).to_pylist())):
                b += b"\0\0\0\0"
                n = len(b) // 4
                at = 0
                for k, end in enumerate(range((n - 1) % capacity + 1, n + 1, capacity)):
                    rows.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(end - at)
                    part = b[4 * at:4 * end]
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(np.frombuffer(part, dtype="<i4"))
                    at = end
            out = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                   pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["k", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                out.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(
        run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)


# --- the plan, on counts ------------------------------------------------------

def filled(lengths: np.ndarray, cost: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to ``capacity``: the greatest sum of ``lengths`` (each as
    often as it likes) that fits, and the last length of the cheapest way to that
    sum (0 for none)."""
    best, last = np.full(capacity + 1, np.inf), np.zeros(capacity + 1, dtype=np.int64)
    best[0] = 0.0
    for total in range(int(lengths[0]), capacity + 1):
        fits = lengths[:np.searchsorted(lengths, total, side="right")]
        ways = best[total - fits] + cost[:len(fits)]
        k = int(ways.argmin())
        best[total], last[total] = ways[k], fits[k] if np.isfinite(ways[k]) else 0
    return np.maximum.accumulate(np.where(np.isfinite(best), np.arange(capacity + 1), 0)), last


COSTS = {
    "plentiful": lambda lengths, counts: 1.0 / counts,  # of the lengths of which there are most
    "few": lambda lengths, counts: np.ones(len(lengths)),  # of the fewest pieces
    "even": lambda lengths, counts: lengths.astype(float) ** 2,  # of the most even lengths
}
FAMILIES = (("plentiful", "few"), ("plentiful", "few", "even"), ("plentiful", "even"), ("even",))


def patterns(counts: dict[int, int], capacity: int, family: tuple[str, ...] = FAMILIES[0]) -> list[tuple[int, ...]]:
    """For each length and each cost of the family, the fullest sequence with it, filled up the cheapest way."""
    lengths = np.array(sorted(counts), dtype=np.int64)
    held = np.array([counts[n] for n in lengths.tolist()])
    found: dict[tuple[int, ...], None] = {}
    for cost in family:
        sums, last = filled(lengths, COSTS[cost](lengths, held), capacity)
        for n in lengths.tolist():
            pattern, left = [n], int(sums[capacity - n])
            while left:
                pattern.append(int(last[left]))
                left -= pattern[-1]
            found[tuple(sorted(pattern, reverse=True))] = None
    return list(found)


def least_squares(columns: list[dict[int, int]], counts: dict[int, int], close: float = 1e-3) -> list[float]:
    """x >= 0 that minimises |sum x_p * column_p - counts|, by coordinate descent,
    until a sweep moves no x by more than ``close`` of the greatest count."""
    rest = {n: float(c) for n, c in counts.items()}
    x, norm = [0.0] * len(columns), [float(sum(m * m for m in col.values())) for col in columns]
    moved, least = np.inf, max(0.5, close * max(counts.values(), default=0))
    while moved > least:
        moved = 0.0
        for p, col in enumerate(columns):
            new = max(0.0, x[p] + sum(m * rest[n] for n, m in col.items()) / norm[p])
            step = new - x[p]
            if step:
                for n, m in col.items():
                    rest[n] -= step * m
                x[p] = new
                moved = max(moved, abs(step))
    return x


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: (lengths of a sequence, how many such)."""
    by_room: dict[int, list[list]] = {}  # free room -> [[lengths, number], ...]
    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            room = min((r for r in by_room if r >= n), default=None)
            if room is None:
                each = capacity // n
                full, odd = divmod(left, each)
                if full:
                    by_room.setdefault(capacity - each * n, []).append([(n,) * each, full])
                if odd:
                    by_room.setdefault(capacity - odd * n, []).append([(n,) * odd, 1])
                break
            lengths, number = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
            each = min(room // n, left)
            take = min(number, left // each)
            if take < number:
                by_room.setdefault(room, []).append([lengths, number - take])
            by_room.setdefault(room - each * n, []).append([lengths + (n,) * each, take])
            left -= take * each
    return [(lengths, number) for groups in by_room.values() for lengths, number in groups]


def chosen(counts: dict[int, int], capacity: int, family: tuple[str, ...], least_part: float = 0.02) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such) for all of ``counts``: patterns of the
    family, fitted again to what is left as long as a round places ``least_part``
    of the tokens that it finds, and best-fit for the rest."""
    rest, out = {n: c for n, c in counts.items() if c}, []
    placed, there = 1, 1
    while rest and placed >= least_part * there:
        there, placed = sum(n * c for n, c in rest.items()), 0
        found = patterns(rest, capacity, family)
        columns = [{n: len(list(g)) for n, g in groupby(p)} for p in found]
        x = least_squares(columns, rest)
        for p in sorted(range(len(found)), key=lambda p: (-sum(found[p]), -x[p], p)):  # the fullest first
            times = min([int(x[p] + 0.5), *(rest.get(n, 0) // m for n, m in columns[p].items())])
            if times:
                out.append((found[p], times))
                placed += times * sum(found[p])
                for n, m in columns[p].items():
                    rest[n] -= m * times
        rest = {n: c for n, c in rest.items() if c}
    return out + best_fit(rest, capacity)


def plan(counts: dict[int, int], capacity: int = 2048) -> np.ndarray:
    """Runs (length, first rank, sequence, copies in a sequence, offset), by
    length and rank: the shortest of the solutions by each family of patterns."""
    best = min((chosen(counts, capacity, f) for f in FAMILIES), key=lambda c: sum(times for _, times in c))
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for lengths, times in best:
        offset = 0
        for n, g in groupby(lengths):
            m = len(list(g))
            runs.append((n, used.get(n, 0), sequence, m, offset))
            used[n] = used.get(n, 0) + m * times
            offset += n * m
        sequence += times
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)


# --- the plan, on pieces ------------------------------------------------------

def pack(pieces: DataFrame, scratch: Scratch, capacity: int = 2048, buckets: int = 20_000) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to every row of ``pieces``, whose
    ``length`` is 1 to ``capacity``. Other columns pass through; repeated rows
    are placed one by one; no rows give no rows.

    ``buckets`` is how many parts the rows are dealt into at most for ranking
    (lengths come on top); it bounds the table of bucket sizes.
    """
    names = pieces.columns
    # Ranks need rows that do not change, and a number that tells equal rows apart.
    pieces = scratch.save(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan(counts, capacity)
    each = max(200, -(-sum(counts.values()) // buckets))
    spread = {n: -(-c // each) for n, c in counts.items() if c > each}  # at most ``buckets`` lengths and buckets
    bucket = F.lit(0)
    if spread:
        spread_of = F.create_map(*[F.lit(x) for n in sorted(spread) for x in (n, spread[n])])
        bucket = F.pmod(F.xxhash64("_row"), F.coalesce(spread_of[F.col("length")], F.lit(1))).cast("int")
    dealt = pieces.withColumn("_bucket", bucket)
    sizes = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")).collect()
    first, seen = {}, dict.fromkeys(counts, 0)
    for r in sorted(sizes, key=lambda r: (r["length"], r["_bucket"])):
        first[r["length"], r["_bucket"]] = seen[r["length"]]
        seen[r["length"]] += r["_n"]
    keys = sorted(first)
    shift = 1 << 32
    bucket_keys = np.array([n * shift + b for n, b in keys], dtype=np.int64)
    bucket_first = np.array([first[k] for k in keys], dtype=np.int64)
    ranked = dealt.withColumn("_rank", F.row_number().over(
        Window.partitionBy("length", "_bucket").orderBy("_row")) - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = np.flatnonzero(np.diff(runs[:, 0], append=-1)) + 1
        last = dict(zip(runs[ends - 1, 0].tolist(), ends.tolist()))
        begin = dict(zip(runs[ends - 1, 0].tolist(), [0, *ends[:-1].tolist()]))
        for batch in batches:
            n = batch.column("length").to_numpy()
            b = batch.column("_bucket").to_numpy().astype(np.int64)
            rank = batch.column("_rank").to_numpy() + bucket_first[np.searchsorted(bucket_keys, n * shift + b)]
            seq, off = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
            for length in np.unique(n):
                rows = np.flatnonzero(n == length)
                own = runs[begin[int(length)]:last[int(length)]]
                run = own[np.searchsorted(own[:, 1], rank[rows], side="right") - 1]
                turn = rank[rows] - run[:, 1]
                seq[rows] = run[:, 2] + turn // run[:, 3]
                off[rows] = run[:, 4] + turn % run[:, 3] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(seq), pa.array(off)],
                                             [*names, "sequence_id", "offset"])

    schema = pieces.select(*names).withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    return ranked.mapInArrow(place, schema)
