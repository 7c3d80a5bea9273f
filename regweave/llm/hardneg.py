"""Hard-negative mining with angular triangle filtering.

Each row keeps its angles to a few reference directions.  The angle between two rows lies between the largest difference
and the smallest sum of their angles to a direction; its cosine, times both norms, bounds their score.  Only rows whose
bounds reach a window that an anchor still looks for get integer scoring.  Rows lie ordered by their nearest direction
and the angle to it, so whole runs of rows fall away by the angles that a run spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regweave.llm.catalog import query
from regweave.session import stored

#: Reference directions, and rows they are chosen from (those with the smallest hashes of their ids).
DIRECTIONS, SAMPLE = 8, 2048
#: Distinct anchors of one pass over all rows, about; rows and anchors that are scored at once.
ANCHORS, RUN, CHUNK = 8192, 2048, 512
#: Rows wanted for each window; slack of an angle (stored in 32 bits) and of a cosine.
FIRST, SLACK, TINY = 5, np.float32(4e-6), 1e-12
_NONE = np.iinfo(np.int64).max


def directions(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors that lie far apart: each the one farthest from those before it; rows without a length are left out."""
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    units = vectors[norm > 0] / norm[norm > 0][:, None]
    if not len(units):
        return np.eye(1, vectors.shape[1])
    chosen, near = [0], units @ units[0]
    while len(chosen) < min(DIRECTIONS, len(units)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, units @ units[chosen[-1]])
    return units[chosen]


def angles(rows: np.ndarray, norms: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Angles of each row to each direction; a row of length 0 has the angle 0, its scores are 0 whatever the angle."""
    cosine = np.divide(rows @ refs.T, norms[:, None], out=np.ones((len(rows), len(refs))), where=norms[:, None] > 0)
    return np.arccos(np.clip(cosine, -1, 1)).astype(np.float32)


def _bounds(a: np.ndarray, r: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest possible score of each pair from both sides' angles and the product of their norms."""
    apart, around = np.zeros(scale.shape, np.float32), np.full(scale.shape, np.pi, np.float32)
    for k in range(a.shape[1]):
        x, y = a[:, k, None], r[None, :, k]
        np.maximum(apart, np.abs(x - y), out=apart)
        both = x + y
        np.minimum(around, np.minimum(both, np.float32(2 * np.pi) - both), out=around)
    high = np.cos(np.maximum(apart - SLACK, 0)).astype(np.float64) + 1e-6
    low = np.cos(np.minimum(around + SLACK, np.float32(np.pi))).astype(np.float64) - 1e-6
    return scale * low - 1, scale * high + 1


def _numbers(column: pa.Array, width: int, kind: str) -> np.ndarray:
    """Binary values of equal length as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


class Search:
    """For every anchor and each of its windows the best rows seen so far, of its own label or of other labels."""

    def __init__(self, anchors: dict[str, np.ndarray], low: np.ndarray, high: np.ndarray, same: bool) -> None:
        self.a, self.low, self.high, self.same = anchors, low, high, same
        shape = (*low.shape, FIRST)
        self.score, self.id, self.full = np.zeros(shape, np.int64), np.full(shape, _NONE), np.zeros(low.shape, np.int64)

    def see(self, rows: dict[str, np.ndarray]) -> None:
        """Rows of one run, against all anchors."""
        t = rows["angles"]
        floor, ceiling, shortest, longest = t.min(axis=0), t.max(axis=0), rows["norm"].min(), rows["norm"].max()
        # Lowest score that still counts for each window: its foot, or the last of the best rows when they are complete.
        foot = np.where(self.full >= FIRST, np.maximum(self.low, self.score[..., -1]), self.low)
        open_ = foot <= self.high
        reach, top = np.where(open_, foot, _NONE).min(axis=1), np.where(open_, self.high, -_NONE).max(axis=1)
        # The run as a whole: its angles to each direction lie between floor and ceiling.
        apart = np.maximum(np.maximum(self.a["angles"] - ceiling, floor - self.a["angles"]), 0).max(axis=1)
        cosine = np.cos(np.maximum(apart - SLACK, 0)).astype(np.float64) + 1e-6
        best = self.a["norm"] * np.where(cosine > 0, longest, shortest) * cosine + 1
        near = np.flatnonzero(open_.any(axis=1) & (best >= reach))
        for at in range(0, len(near), CHUNK):
            self._score(near[at : at + CHUNK], rows, reach, top, foot)

    def _score(self, who: np.ndarray, rows: dict[str, np.ndarray], reach: np.ndarray, top: np.ndarray, foot: np.ndarray) -> None:
        a = {k: v[who] for k, v in self.a.items()}
        low, high = _bounds(a["angles"], rows["angles"], a["norm"][:, None] * rows["norm"][None, :])
        wanted = (high >= reach[who][:, None]) & (low <= top[who][:, None])
        wanted &= (a["label"][:, None] == rows["label"][None, :]) == self.same
        wanted &= a["id"][:, None] != rows["id"][None, :]
        some, columns = wanted.any(axis=1), wanted.any(axis=0)
        if not some.any():
            return
        who, wanted, x, y = who[some], wanted[some][:, columns], a["v"][some], rows["v"][columns]
        ids = rows["id"][columns]
        # Sums of products below 2^53 are whole in 64-bit floats; beyond, integers are multiplied.
        exact = float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) * x.shape[1] < 2**53
        scores = (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64) if exact else x.astype(np.int64) @ y.astype(np.int64).T
        for w in range(self.low.shape[1]):
            held = wanted & (scores >= foot[who, w][:, None]) & (scores <= self.high[who, w][:, None])
            if held.shape[1] > FIRST:
                ranked = np.where(held, scores, -_NONE)
                held &= scores >= np.partition(ranked, -FIRST, axis=1)[:, -FIRST][:, None]
            i, j = np.nonzero(held)
            if len(i):
                self._merge(who, w, i, scores[i, j], ids[j])

    def _merge(self, who: np.ndarray, w: int, owner: np.ndarray, score: np.ndarray, id: np.ndarray) -> None:
        touched = np.unique(owner)
        old = np.repeat(touched, FIRST)
        owner, score = np.concatenate([old, owner]), np.concatenate([self.score[who[touched], w].ravel(), score])
        # Places that are not taken have the largest id and are put last.
        taken = np.concatenate([(np.arange(FIRST) < self.full[who[touched], w][:, None]).ravel(), np.ones(len(id), bool)])
        id = np.concatenate([self.id[who[touched], w].ravel(), id])
        owner, score, id = owner[taken], score[taken], id[taken]
        order = np.lexsort((id, -score, owner))
        owner, score, id = owner[order], score[order], id[order]
        start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        place = np.arange(len(owner)) - np.repeat(start, np.diff(np.r_[start, len(owner)]))
        kept = place < FIRST
        at = who[owner[kept]]
        self.score[at, w, place[kept]], self.id[at, w, place[kept]] = score[kept], id[kept]
        self.full[who[touched], w] = np.bincount(owner[kept], minlength=touched[-1] + 1)[touched]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, window, score and id of every row held."""
        a, w, k = np.nonzero(np.arange(FIRST) < self.full[..., None])
        return a, w, self.score[a, w, k], self.id[a, w, k]


def indexed(vectors: DataFrame, id: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """All rows that take part, scaled to integers, with norm and angles, ordered by nearest direction and angle; the width."""
    x = F.col("_vector")
    rows = vectors.select(F.col(id).cast("bigint").alias("_id"), F.col(label).cast("bigint").alias("_label"), F.col(vector).cast("array<double>").alias("_vector"))
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.filter(F.col("_id").isNotNull() & F.col("_label").isNotNull() & x.isNotNull() & whole)
    rows = rows.withColumn("_label", F.when(F.col("_id") % 7 == 0, (F.col("_label") + 1) % 10).otherwise(F.col("_label")))
    width = max(rows.agg(F.max(F.size(x))).first()[0] or 0, 1)
    limit = min(isqrt((1 << 62) // width), (1 << 31) - 1)

    def matrix(column: pa.Array) -> np.ndarray:
        flat, sizes = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), column.value_lengths().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore"):
            flat = np.clip(np.floor(256 * flat), -limit, limit)
        out = np.zeros((len(sizes), width))
        out[np.arange(width) < sizes[:, None]] = flat
        return out

    sample = rows.orderBy(F.xxhash64("_id"), "_id", x).limit(SAMPLE).toArrow()
    refs = directions(matrix(sample["_vector"].combine_chunks())) if sample.num_rows else np.eye(1, width)
    held = vectors.sparkSession.sparkContext.broadcast(refs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column("_vector"))
            norm = np.sqrt((v * v).sum(axis=1))
            own = angles(v, norm, held.value)
            home = own.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_label"), pa.array([r.tobytes() for r in v.astype("<i4")], pa.binary()), pa.array(norm),
                 pa.array([r.tobytes() for r in own], pa.binary()), pa.array(home.astype(np.int32)), pa.array(own[np.arange(len(own)), home])],
                names=["id", "label", "v", "norm", "angles", "home", "near"])

    out = stored(rows.mapInArrow(run, "id bigint, label bigint, v binary, norm double, angles binary, home int, near float"))
    order = ["home", "near", "id"]
    return stored(out.repartitionByRange(*order).sortWithinPartitions(*order).drop("home", "near")), width


def _arrays(table: pa.Table | pa.RecordBatch, width: int) -> dict[str, np.ndarray]:
    columns = {c: table.column(c) for c in ("id", "label", "v", "norm", "angles")}
    k = len(columns["angles"][0].as_py()) // 4
    return {"id": columns["id"].to_numpy(), "label": columns["label"].to_numpy(), "norm": columns["norm"].to_numpy(),
            "v": _numbers(columns["v"], width, "<i4"), "angles": _numbers(columns["angles"], k, "<f4")}


def _search(index: DataFrame, width: int, anchors: dict[str, np.ndarray], low: np.ndarray, high: np.ndarray, same: bool) -> DataFrame:
    """Best rows of each anchor and window: ``a``, ``w``, ``rank``, ``score``, ``id``."""
    held = index.sparkSession.sparkContext.broadcast((anchors, low, high))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*held.value, same)
        for batch in batches:
            for at in range(0, batch.num_rows, RUN):
                search.see(_arrays(batch.slice(at, RUN), width))
        a, w, score, id = search.found()
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(w.astype(np.int32)), pa.array(score), pa.array(id)], names=["a", "w", "score", "id"])

    best = index.mapInArrow(run, "a int, w int, score bigint, id bigint")
    rank = F.row_number().over(Window.partitionBy("a", "w").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= FIRST)


def hard_negatives(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 100) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows whose id is a multiple of ``every``; the contract's labels, scores, positives and windows hold.
    Rows without an id take no part, as those without a label or with a null or non-finite component.  Shorter vectors
    count as filled with zeros; empty ones score 0.  Scaled components beyond what lets every score fit a long are held
    at that limit (2^28 for 64 components).  Of equal scores and ids either row may be given: they read alike.  Equal
    anchor rows count once, other rows that repeat count each; a row with the anchor's own id is neither positive nor
    negative.  An empty table gives an empty table; other columns are not read.

    Anchors pass in blocks of bounded size, each against all rows; tasks return at most 5 rows for each anchor and window.
    """
    index, width = indexed(vectors, id, vector, label)
    anchors = index.filter(F.col("id") % every == 0).distinct()
    blocks = -(-anchors.count() // ANCHORS)
    out = None
    for block in range(blocks):
        own = anchors.filter(F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks)) == block).orderBy("id", "label", "v").toArrow()
        if not own.num_rows:
            continue
        own = _arrays(own.combine_chunks(), width)
        n = len(own["id"])
        got = _search(index, width, own, np.full((n, 1), -_NONE), np.full((n, 1), _NONE), same=True).toArrow()
        a, place = got["a"].to_numpy(), got["rank"].to_numpy() - 1
        # Windows of the positives: 80 p <= 100 s <= 100 p is p - floor(p / 5) <= s <= p; none for p below 0.
        high, positive, low = np.full((n, FIRST), -1), np.zeros((n, FIRST), np.int64), np.zeros((n, FIRST), np.int64)
        high[a, place], positive[a, place] = got["score"].to_numpy(), got["id"].to_numpy()
        low = np.where(high >= 0, high - high // 5, 0)
        found = _search(index, width, own, low, np.maximum(high, -1), same=False)
        names = index.sparkSession.createDataFrame(pa.table({"a": pa.array(a), "w": pa.array(place.astype(np.int32)), "anchor_id": own["id"][a], "positive_id": got["id"], "positive_score": got["score"]}))
        rows = found.join(names, ["a", "w"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else vectors.sparkSession.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")


@query("op11_hard_negatives")
def op11(t):
    """Hard negatives of every anchor."""
    return hard_negatives(t.embeddings)
