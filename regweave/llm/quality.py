"""Quality rules: fixed rules first, then gradient-boosted trees over document statistics.

The trees are grown here with histograms, logistic loss and monotonic constraints, and flattened into arrays
of nodes, so that a batch of documents is scored with a few array operations per level.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.llm.batches import batch_of, slices
from regweave.llm.catalog import query

#: Labelled rows that the trees are fitted to, at most.
SAMPLE = 6000
#: Fixed rules: fewest words, largest share (per cent) of words in repeated windows, words of a window.
FEWEST_WORDS, REPEATED_PERCENT, WINDOW = 20, 30, 8

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics the trees see, with the direction of their constraint (-1: more is never better).
FEATURES = {
    "symbols_per_word": -1, "upper_share": -1, "repeat_share": -1, "dup_line_share": -1, "pipe_share": -1, "bang_share": -1,
    "mean_word": 0, "log_words": 0, "digit_share": 0, "distinct_share": 0, "short_share": 0, "punct_share": 0, "line_words": 0,
}
_SYMBOLS = re.compile(rb"[#*$%&|<>]")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more, first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    names = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return 0
    # Names of windows of 1, 2, 4 ... words, each pair of names getting a name of its own.
    size = 1
    while size < window:
        step = min(size, window - size)
        pairs = names[:-step] * (int(names.max()) + 1) + names[step:]
        names = np.unique(pairs, return_inverse=True)[1]
        size += step
    hits = np.bincount(names)[names] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(hits), 1)
    np.add.at(cover, np.flatnonzero(hits) + window, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """The five base counts and the features of a whole text."""
    words = text.split()
    n = len(words)
    joined = b"".join(words)
    word_chars = len(joined.decode())
    symbols = len(_SYMBOLS.findall(text))
    seen: set[bytes] = set()
    dup = lines = 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\r\x0b\x0c"):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeat = repeated_words(words)
    one = max(1, n)
    letters = max(1, len(joined))
    upper = sum(map(joined.count, _UPPER)) if joined else 0
    distinct = len(set(words))
    short = sum(1 for w in words if len(w) <= 3)
    features = [
        symbols / one, upper / letters, repeat / one, dup / max(1, lines), text.count(b"|") / one, text.count(b"!") / one,
        word_chars / one, float(np.log1p(n)), sum(map(joined.count, _DIGITS)) / letters, distinct / one, short / one,
        (text.count(b".") + text.count(b",")) / one, n / max(1, lines),
    ]
    return [n, word_chars, symbols, dup, repeat], features


_UPPER = [bytes([c]) for c in range(65, 91)]
_DIGITS = [bytes([c]) for c in range(48, 58)]


# Trees


@dataclass
class Trees:
    """Flattened trees: node ``i`` tests ``feature[i] <= split[i]``, else holds ``value[i]`` (feature -1)."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        node = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        while (self.feature[node] >= 0).any():
            f = self.feature[node]
            at = x[rows, np.maximum(f, 0)]
            node = np.where(f < 0, node, np.where(at <= self.split[node], self.left[node], self.right[node]))
        return self.base + self.value[node].sum(axis=1)


def grow(x: np.ndarray, y: np.ndarray, directions: list[int], trees: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 64,
         least: int = 8, ridge: float = 1.0) -> Trees:
    """Boosted trees with logistic loss; ``directions`` of +1 or -1 make the score monotonic in a feature.

    A split against a feature's direction is refused, and both sides of an accepted one keep to their side of
    the mean of the two values, so the whole tree is monotonic.  Without rows or with one class only the base
    odds are returned.
    """
    feature, split, left, right, value, roots = [], [], [], [], [], []
    rate_of = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    base = float(np.log(rate_of / (1 - rate_of)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1) if len(x) else np.empty((0, 0), int)
    score = np.full(len(y), base)

    def leaf(g: float, h: float, lo: float, hi: float) -> float:
        return float(np.clip(-g / (h + ridge), lo, hi))

    def add(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, lo: float, hi: float) -> int:
        me = len(feature)
        for store, v in zip((feature, split, left, right, value), (-1, 0.0, me, me, 0.0)):
            store.append(v)
        sg, sh = g[rows].sum(), h[rows].sum()
        best = (1e-6, None)
        if level < depth and len(rows) >= 2 * least:
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, f]
                n = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                gl = np.cumsum(np.bincount(b, weights=g[rows], minlength=len(e) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, weights=h[rows], minlength=len(e) + 1))[:-1]
                vl, vr = np.clip(-gl / (hl + ridge), lo, hi), np.clip(-(sg - gl) / (sh - hl + ridge), lo, hi)
                gain = gl**2 / (hl + ridge) + (sg - gl) ** 2 / (sh - hl + ridge) - sg**2 / (sh + ridge)
                ok = (n >= least) & (len(rows) - n >= least) & ((vr - vl) * directions[f] >= 0)
                gain = np.where(ok, gain, -1.0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), (f, k, float(vl[k]), float(vr[k])))
        if best[1] is None:
            value[me] = rate * leaf(sg, sh, lo, hi)
            return me
        f, k, vl, vr = best[1]
        feature[me], split[me] = f, float(edges[f][k])
        go = binned[rows, f] <= k
        mid = (vl + vr) / 2
        bounds = {0: ((lo, hi), (lo, hi)), 1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid))}[directions[f]]
        left[me] = add(rows[go], g, h, level + 1, *bounds[0])
        right[me] = add(rows[~go], g, h, level + 1, *bounds[1])
        return me

    for _ in range(trees if len(y) and 0 < y.mean() < 1 else 0):
        p = 1 / (1 + np.exp(-score))
        roots.append(add(np.arange(len(y)), p - y, p * (1 - p), 0, -4.0, 4.0))
        arrays = [np.array(a) for a in (feature, split, left, right, value)]
        score += Trees(*arrays, np.array(roots[-1:]), 0.0).score(x)
    if not roots:
        feature, split, left, right, value, roots = [-1], [0.0], [0], [0], [0.0], [0]
    return Trees(np.array(feature), np.array(split), np.array(left), np.array(right), np.array(value), np.array(roots), base)


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Trees:
    """Trees for a bounded sample of the labelled rows, those with the smallest hashes of their ids.

    Rows without a label and ids without a document are not used; no labelled rows give trees that keep all.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull()).select(F.col(id).alias("_id"), F.col(label).cast("int").alias("_y"))
    known = known.groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text")).join(known, "_id")
    # Of rows that share an id one is taken, the least text.
    rows = rows.groupBy("_id", "_y").agg(F.min("_text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("_y", pa.int32()), ("x", pa.list_(pa.float64()))])
        for part, texts in slices(batches, "_text"):
            yield batch_of(schema, part.column("_y"), [statistics(t)[1] for t in texts])

    got = sorted((r._y, r.x) for r in rows.mapInArrow(run, "_y int, x array<double>").collect())
    x = np.array([g[1] for g in got], float).reshape(len(got), len(FEATURES))
    return grow(x, np.array([g[0] for g in got], float), list(FEATURES.values()))


def judge(docs: DataFrame, trees: Trees, id: str = "doc_id", text: str = "text", floor: float = 0.0) -> DataFrame:
    """``id``, base counts, ``base_failed``, ``score`` (log odds) and ``kept`` of every whole text.

    Null and empty texts have no words and fail the base rules; null ids and repeated rows are kept; an empty
    table gives an empty table; other columns are not read.
    """
    docs = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    # Bounded: the number and depth of the trees are constants.
    held = docs.sparkSession.sparkContext.broadcast((trees.feature, trees.split, trees.left, trees.right, trees.value, trees.roots, trees.base))
    counts = ", ".join(f"{c} bigint" for c in BASE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Trees(*held.value)
        for part, texts in slices(batches, "_text"):
            got = [statistics(t) for t in texts]
            base = np.array([g[0] for g in got], np.int64).reshape(len(got), len(BASE))
            score = model.score(np.array([g[1] for g in got], float).reshape(len(got), len(FEATURES)))
            n, repeat = base[:, 0], base[:, 4]
            failed = (n < FEWEST_WORDS) | (100 * repeat > REPEATED_PERCENT * n)
            columns = [part.column("_id"), *(pa.array(base[:, i]) for i in range(len(BASE))), pa.array(failed), pa.array(score), pa.array(~failed & (score >= floor))]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", *BASE, "base_failed", "score", "kept"])

    out = docs.mapInArrow(run, f"_id {docs.schema['_id'].dataType.simpleString()}, {counts}, base_failed boolean, score double, kept boolean")
    return out.withColumnRenamed("_id", id)


@query("op4_quality_trees")
def op4(t):
    """Base counts and the verdict on every document."""
    return judge(t.documents, fit(t.documents, t.labels))
