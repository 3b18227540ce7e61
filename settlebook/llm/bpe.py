"""Byte-level BPE encoding and decoding (operator 2).

A segment tree over byte positions holds, per live position, the rank of the
pair that starts there (no pair: a rank above all others); inner nodes hold the
leftmost minimum, so the root names the next merge. A merge takes the right
part out of the list of live positions and updates three leaves (the merged
position, the part taken out, the left neighbour), each along one path to the
root. ``merge_short`` runs many short pieces side by side, one tree per row of
a numpy array; ``merge_long`` runs one tree for a long piece, O(n log n).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settlebook.llm.chunks import ChunkEncoder

NONE = 1 << 40  # rank of "no such pair"
SHORT = 32  # bytes of a piece that is merged side by side with others


class Vocabulary:
    """Ranks of byte strings from a tiktoken file, and the ranks of pairs: two
    tokens may merge if their concatenation is a token."""

    def __init__(self, path: str):
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token)] = int(rank)
        self.bytes_of: dict[int, bytes] = {r: t for t, r in self.ranks.items()}
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = [(self.ranks[t[:i]] << 32 | self.ranks[t[i:]], r) for t, r in self.ranks.items()
                 for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs] + [1 << 62], dtype=np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] + [NONE], dtype=np.int64)
        self.pair_rank = dict(pairs)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)


def merge_short(pieces: list[bytes], voc: Vocabulary, size: int) -> list[bytes]:
    """Ids (uint32 bytes) of pieces of at most ``size`` bytes, all at once."""
    n = len(pieces)
    if not n:
        return []
    length = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
    raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), dtype=np.uint8).reshape(n, size)
    pos = np.arange(size, dtype=np.int64)
    ids = voc.byte_id[raw]
    live = pos < length[:, None]
    right = np.broadcast_to(pos + 1, (n, size)).copy()  # next live position; size or more: none
    right[right >= length[:, None]] = size
    left = np.broadcast_to(pos - 1, (n, size)).copy()  # previous live position, -1: none
    tree = np.full((n, 2 * size), NONE << 8, dtype=np.int64)  # rank << 8 | position
    has = right[:, :-1] < size
    rank = np.where(has, voc.ranks_of(ids[:, :-1], ids[:, 1:]), NONE)
    tree[:, size:2 * size - 1] = rank << 8 | pos[:-1]
    for node in range(size - 1, 0, -1):
        np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
    depth = size.bit_length() - 1

    def update(rows, leaf, value):
        node = leaf + size
        tree[rows, node] = value
        for _ in range(depth):
            node >>= 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def pair_at(rows, a, b):
        """Leaf value of the pair at live positions a, b (b = size: none)."""
        ok = b < size
        r = voc.ranks_of(ids[rows, a], ids[rows, np.where(ok, b, 0)])
        return np.where(ok, r, NONE) << 8 | a

    rows = np.flatnonzero(tree[:, 1] >> 8 < NONE)
    while len(rows):
        best = tree[rows, 1]
        a = best & 255
        b = right[rows, a]
        c = right[rows, b]
        ids[rows, a] = best >> 8
        live[rows, b] = False
        right[rows, a] = c
        inner = c < size
        left[rows[inner], c[inner]] = a[inner]
        update(rows, b, NONE << 8 | b)
        update(rows, a, pair_at(rows, a, c))
        before = left[rows, a]
        some = before >= 0
        update(rows[some], before[some], pair_at(rows[some], before[some], a[some]))
        rows = rows[tree[rows, 1] >> 8 < NONE]
    flat = ids[live].astype("<u4").tobytes()
    ends = np.cumsum(live.sum(axis=1)) * 4
    return [flat[s:e] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist())]


def merge_long(piece: bytes, voc: Vocabulary) -> bytes:
    """Ids (uint32 bytes) of one piece of any length."""
    n = len(piece)
    size = 1 << max(1, (n - 1).bit_length())
    shift = size.bit_length()
    none = NONE << shift
    ids = voc.byte_id[np.frombuffer(piece, dtype=np.uint8)]
    tree = np.full(2 * size, none, dtype=np.int64)
    if n > 1:
        tree[size:size + n - 1] = voc.ranks_of(ids[:-1], ids[1:]) << shift | np.arange(n - 1)
    width = size
    while width > 1:  # one level at a time
        tree[width // 2:width] = np.minimum(tree[width:2 * width:2], tree[width + 1:2 * width:2])
        width //= 2
    tree, ids = tree.tolist(), ids.tolist()
    right, left, live = [*range(1, n), -1], list(range(-1, n - 1)), bytearray(b"\1") * n
    rank, mask = voc.pair_rank.get, (1 << shift) - 1

    def update(leaf, value):
        node = leaf + size
        tree[node] = value
        while node > 1:
            a, b = tree[node], tree[node ^ 1]
            node >>= 1
            least = a if a < b else b
            if tree[node] == least:
                return
            tree[node] = least

    while tree[1] < none:
        a, ids_a = tree[1] & mask, tree[1] >> shift
        b = right[a]
        c = right[b]
        ids[a], live[b], right[a] = ids_a, 0, c
        update(b, none)
        if c >= 0:
            left[c] = a
            update(a, rank(ids_a << 32 | ids[c], NONE) << shift | a)
        else:
            update(a, none)
        p = left[a]
        if p >= 0:
            update(p, rank(ids[p] << 32 | ids_a, NONE) << shift | p)
    return np.array(ids, dtype="<u4")[np.frombuffer(bytes(live), dtype=np.uint8) == 1].tobytes()


class Encoder:
    """Text to ids: each match of ``pattern`` by itself, a match that is a
    token as that token, all others by merging."""

    def __init__(self, path: str, pattern: str, most: int = 48 << 20):
        self.voc, self.split, self.most = Vocabulary(path), regex.compile(pattern).findall, most
        self.known: dict[str, bytes] = {}  # matches of up to SHORT bytes, in about ``most`` bytes of memory
        self.held = 0
        self.texts = ChunkEncoder(self.encode_pieces)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        if self.held > self.most:
            self.known.clear()
            self.held = 0
        parts = [self.split(p) for p in pieces]
        known, passing = self.known, {}
        new = dict.fromkeys(m for ms in parts for m in ms if m not in known)
        queues: dict[int, list[tuple[str, bytes]]] = {8: [], 16: [], SHORT: []}
        for m in new:
            b = m.encode()
            r = self.voc.ranks.get(b)
            if r is not None:
                known[m] = r.to_bytes(4, "little")
            elif len(b) > SHORT:
                passing[m] = merge_long(b, self.voc)
            else:
                queues[8 if len(b) <= 8 else 16 if len(b) <= 16 else SHORT].append((m, b))
        for size, queue in queues.items():
            for i in range(0, len(queue), 8192):
                part = queue[i:i + 8192]
                known.update(zip((m for m, _ in part), merge_short([b for _, b in part], self.voc, size)))
        self.held += 300 * (len(new) - len(passing))  # a match, its ids and a place in the table
        if not passing:
            return [b"".join(map(known.__getitem__, ms)) for ms in parts]
        return [b"".join([known[m] if m in known else passing[m] for m in ms]) for ms in parts]

    def encode(self, texts) -> Iterator[np.ndarray]:
        for b in self.texts(texts):
            yield np.frombuffer(b, dtype="<u4")


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per vocabulary and worker process."""
    key = (path, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, pattern)
    return _ENCODERS[key]


def encode_decode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes each whole ``text`` and decodes its ids.

    Returns ``key``, ``ids`` array<int> and ``decoded`` binary, a row per input
    row. Null and empty texts have no ids and decode to nothing; null or
    repeated keys pass through; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        bytes_of = enc.voc.bytes_of
        for batch in batches:
            texts = (t or "" for t in batch.column(1).to_pylist())
            keys, part, size = batch.column(0), [], 0
            start = 0
            for ids in enc.encode(texts):
                part.append(ids)
                size += len(ids)
                if size >= 4_000_000:
                    yield _decoded(keys.slice(start, len(part)), part, bytes_of)
                    start, part, size = start + len(part), [], 0
            if part:
                yield _decoded(keys.slice(start, len(part)), part, bytes_of)

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(
        run, f"`{key}` {kind}, ids array<int>, decoded binary")


def _decoded(keys: pa.Array, part: list[np.ndarray], bytes_of: dict[int, bytes]) -> pa.RecordBatch:
    offsets = np.zeros(len(part) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in part], out=offsets[1:])
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(part).astype(np.int32)))
    decoded = pa.array([b"".join(map(bytes_of.__getitem__, p.tolist())) for p in part], pa.binary())
    return pa.RecordBatch.from_arrays([keys, ids, decoded], ["k", "ids", "decoded"])
