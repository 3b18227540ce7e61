"""Language identification by a byte convolutional network (operator 10).

A text's UTF-8 bytes are reduced to 64 classes and cut into windows of fixed
length. Filters of two, three and four bytes slide over a window, the greatest
response of each filter is kept, and a softmax over those gives the window's
languages. A text's score for a language is the mean over all its windows,
weighted by their length. The network is trained with numpy on a bounded sample
of labelled texts, and then travels to the tasks (some tens of kilobytes).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlebook.llm.scratch import bounded_batches

CLASSES, LENGTH, WIDTHS = 64, 256, (2, 3, 4)


def lettered(text: str) -> Column:
    """The text if it has a letter (Unicode category L), else null: the one test for learning and prediction."""
    return F.when(F.col(text).rlike(r"\p{L}"), F.col(text))


def _class_table() -> np.ndarray:
    """Other, space, digit, a to z (either case), continuation bytes by their
    low five bits, and three groups of lead bytes."""
    t = np.zeros(256, dtype=np.uint8)
    t[[9, 10, 11, 12, 13, 32]] = 1
    t[48:58] = 2
    t[97:123] = t[65:91] = np.arange(3, 29)
    t[128:192] = 29 + (np.arange(64) & 31)
    t[192:200], t[200:224], t[224:256] = 61, 62, 63
    return t


CLASS_OF = _class_table()


@dataclass
class Network:
    languages: list[str]
    filters: list[np.ndarray]  # per width: (width, CLASSES, number of filters)
    biases: list[np.ndarray]
    weights: np.ndarray  # (all filters, languages)
    offset: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """Per width, the filters' responses to two bytes at once (and to a last single one)."""
        out = []
        for f, b in zip(self.filters, self.biases):
            steps = [(f[i][:, None, :] + f[i + 1][None, :, :]).reshape(CLASSES * CLASSES, -1) for i in range(0, len(f) - 1, 2)]
            if len(f) % 2:
                steps.append(f[-1])
            steps[0] = steps[0] + b
            out.append([np.ascontiguousarray(s, dtype=np.float32) for s in steps])
        return out

    def pooled(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Greatest response of each filter, per window of classes."""
        single = windows.astype(np.int32)
        pair = single[:, :-1] * CLASSES + single[:, 1:]
        parts = []
        for width, steps in zip(WIDTHS, tables):
            places = windows.shape[1] - width + 1
            total = np.take(steps[0], pair[:, :places], axis=0)
            for k, step in enumerate(steps[1:], 1):
                total += np.take(step, (pair if len(step) > CLASSES else single)[:, 2 * k:2 * k + places], axis=0)
            parts.append(total.max(axis=1))
        return np.maximum(np.concatenate(parts, axis=1), 0.0)

    def probabilities(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        z = self.pooled(windows, tables) @ self.weights + self.offset
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def windows_of(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Windows of classes that cover the whole text, and the bytes in each."""
    n = max(1, -(-len(text) // length))
    classes = np.zeros(n * length, dtype=np.uint8)
    classes[:len(text)] = CLASS_OF[np.frombuffer(text, dtype=np.uint8)]
    sizes = np.full(n, length, dtype=np.int64)
    sizes[-1] = len(text) - (n - 1) * length
    return classes.reshape(n, length), sizes


def train(texts: list[str], labels: list[str], filters: int = 16, steps: int = 1500, steps_each: int = 25, batch: int = 64, seed: int = 7) -> Network:
    """A network fitted to the labelled texts by Adam on the cross entropy,
    with a rate that falls to a fiftieth; ``steps``, or ``steps_each`` per
    language if that is more."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    steps = max(steps, steps_each * len(languages))
    x, y = [], []
    for t, label in zip(texts, labels):
        w, sizes = windows_of(t.encode())
        x.append(w)
        y += [languages.index(label)] * len(w)
    x, y = np.concatenate(x), np.array(y)
    by_language = [np.flatnonzero(y == k) for k in range(len(languages))]
    net = Network(languages, [rng.normal(0, 0.3, (w, CLASSES, filters)) for w in WIDTHS], [np.zeros(filters) for _ in WIDTHS],
                  rng.normal(0, 0.3, (filters * len(WIDTHS), len(languages))), np.zeros(len(languages)))
    params = [*net.filters, *net.biases, net.weights, net.offset]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    k = len(WIDTHS)
    for step in range(1, steps + 1):
        pick = np.array([rng.choice(by_language[c]) for c in rng.integers(0, len(languages), batch)])
        single = x[pick].astype(np.int64)
        best, where = [], []
        for f, b, width in zip(net.filters, net.biases, WIDTHS):
            places = LENGTH - width + 1
            r = sum(f[i][single[:, i:i + places]] for i in range(width)) + b
            where.append(r.argmax(axis=1))
            best.append(np.take_along_axis(r, where[-1][:, None, :], axis=1)[:, 0])
        h = np.maximum(np.concatenate(best, axis=1), 0)
        z = h @ net.weights + net.offset
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(batch), y[pick]] -= 1
        p /= batch
        back = (p @ net.weights.T) * (h > 0)
        grads: list[np.ndarray] = []
        for j, width in enumerate(WIDTHS):
            g, part = np.zeros_like(net.filters[j]), back[:, j * filters:(j + 1) * filters]
            for i in range(width):
                hit = np.take_along_axis(single, where[j] + i, axis=1)
                np.add.at(g[i], (hit, np.broadcast_to(np.arange(filters), hit.shape)), part)
            grads.append(g)
        grads += [back[:, j * filters:(j + 1) * filters].sum(axis=0) for j in range(k)] + [h.T @ p, p.sum(axis=0)]
        for i, (q, g) in enumerate(zip(params, grads)):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            q -= 0.01 * (1.02 - step / steps) * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return net


def sample(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = 400,
           chars: int = 500, labels: int = 1000, most: int = 80_000) -> tuple[list[str], list[str]]:
    """The training sample: excerpts of at most ``per_label`` rows of each of the
    ``labels`` labels that the most rows have, and of ``most`` rows in all (so at
    most 40 MB of text reach the driver, whatever the column holds), from
    documents whose crc32 of the key as text is no multiple of 5 and that have a
    letter.

    A text takes part if its hash falls under its language's share, which the
    language's row count sets to half as many again as are wanted; the driver
    keeps the lowest hashes. So nothing but counts is grouped by language.
    """
    known = docs.select(F.col(key).alias("key"), lettered(text).alias("t"), F.col(label).alias("label")).where(F.col("label").isNotNull())
    known = known.where(F.col("t").isNotNull() & (F.crc32(F.col("key").cast("string").cast("binary")) % 5 != 0))
    counts = known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(labels).collect()
    if not counts:
        return [], []
    per_label = min(per_label, max(1, most // len(counts)))
    span = 1 << 40
    share = F.create_map(*[x for r in counts for x in (F.lit(r["label"]), F.lit(min(span, 3 * per_label * span // (2 * r["n"]))).cast("long"))])
    h = F.xxhash64("key", "t")
    own = known.where(F.pmod(h, F.lit(span)) < share[F.col("label")])
    place = F.pmod(h, F.greatest(F.length("t") - chars, F.lit(1))).cast("int") + 1
    rows = own.select("label", F.pmod(h, F.lit(span)).alias("h"), F.substring(F.col("t"), place, F.lit(chars)).alias("t")).collect()
    rows.sort(key=lambda r: (r["label"], r["h"], r["t"]))
    taken: dict[str, list[str]] = {}
    for r in rows:
        texts = taken.setdefault(r["label"], [])
        if len(texts) < per_label:
            texts.append(r["t"])
    return [t for texts in taken.values() for t in texts], [k for k, texts in taken.items() for _ in texts]


def _scores(net: Network, tables: list[list[np.ndarray]], texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text its mean probabilities over all windows (zeros for a null), and its bytes."""
    sums, totals = np.zeros((len(texts), len(net.languages))), np.zeros(len(texts))
    held, rows, sizes, count = [], [], [], 0

    def flush() -> None:
        nonlocal count
        x, r, s = np.concatenate(held), np.concatenate(rows), np.concatenate(sizes)
        for i in range(0, len(x), 512):  # some 10 MB of responses at a time
            np.add.at(sums, r[i:i + 512], net.probabilities(x[i:i + 512], tables) * s[i:i + 512, None])
        np.add.at(totals, r, s)
        held.clear(), rows.clear(), sizes.clear()
        count = 0

    for k, t in enumerate(texts):
        if t.is_valid:
            w, s = windows_of(memoryview(t.as_buffer()))
            held.append(w)
            rows.append(np.full(len(w), k))
            sizes.append(s)
            count += len(w)
            if count >= 8192:
                flush()
    if held:
        flush()
    return np.clip(sums / np.maximum(totals, 1)[:, None], 0.0, 1.0), totals


def predict(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``<key>, lang_pred, score`` per row, from whole texts.

    ``und`` with score 0 for null texts, texts without a letter, and all texts
    if there is no network (nothing was labelled). Null and repeated keys pass
    through; columns that are not named are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net else []
        for batch in batches:
            n = batch.num_rows
            lang, best = ["und"] * n, np.zeros(n)
            if net:
                score, totals = _scores(net, tables, batch.column(1))
                lang = [net.languages[b] if k else "und" for b, k in zip(score.argmax(axis=1), totals)]
                best = score.max(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(best, pa.float64())],
                                             ["k", "lang_pred", "score"])

    bounded_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), lettered(text).alias("t")).mapInArrow(
        run, f"`{key}` {kind}, lang_pred string, score double")


def only_known(docs: DataFrame, net: Network | None, least: float, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores at least
    ``least`` for one of the languages; none if there is no network.

    Texts alone go to the Python workers, and a number comes back for each: the
    rows themselves stay where they are.
    """
    if net is None:
        return docs.where("false")

    def best(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = net.tables()
        for texts in parts:
            score, totals = _scores(net, tables, texts)
            yield pa.array(np.where(totals > 0, score.max(axis=1, initial=0.0), -1.0), pa.float64())

    best.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    bounded_batches(docs.sparkSession)
    return docs.where(F.arrow_udf(best, "double")(lettered(text)) >= least)


def fit(docs: DataFrame, **bounds) -> Network | None:
    """The network for a table; None if it has no labelled text to learn from."""
    texts, labels = sample(docs, **bounds)
    return train(texts, labels) if texts else None
