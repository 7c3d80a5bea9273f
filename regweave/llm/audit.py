"""Filter interaction audit: what each of five filters removes in every order, and its Shapley share.

The game: a coalition of filters is worth the documents that it removes.  Its potentials follow from smaller
coalitions; a filter's Shapley share is the grand potential less the potential without it.  The step of an order is the
difference of two coalitions, so all 120 orders follow from 32 counts a part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.llm.batches import slices
from regweave.llm.catalog import query
from regweave.session import stored

FILTERS = "ABCDE"
#: Fewest words; least percentage of distinct words; highest percentage of capitals; characters that no text may hold.
WORDS, DISTINCT, CAPITALS, MARKS = 50, 65, 5, b"#$%&*|"
_CAPITALS = bytes(range(65, 91))
_ALL = (1 << len(FILTERS)) - 1


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()
    n = len(words)
    points = len(text) - sum(map(text.count, _TAILS)) if not text.isascii() else len(text)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (n < WORDS) | (100 * len(set(words)) < DISTINCT * n) << 1 | (100 * capitals > CAPITALS * points) << 2 | bool(_MARK.search(text)) << 3


_TAILS = [bytes([c]) for c in range(0x80, 0xC0)]
_MARK = re.compile(b"[" + re.escape(MARKS) + b"]")


def judged(docs: DataFrame, labels: DataFrame, id: str, text: str, part: str) -> DataFrame:
    """Documents counted by ``part``, failure bits ``mask``, ``good`` and ``toxic``: ``n``.

    Rows of a text are told apart by its SHA-256.  They are counted before the least id of each text is sought and
    joined back on (digest, id), so no task gets all copies of a text.
    """
    rows = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "_text"):
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            masks = pa.array(map(failures, texts), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("part"), digests, masks], names=["_id", "part", "digest", "mask"])

    kind = rows.schema["_id"].dataType.simpleString()
    known = labels.groupBy(F.col(id).alias("_id")).agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    each = stored(rows.mapInArrow(run, f"_id {kind}, part string, digest binary, mask int").groupBy("_id", "part", "digest", "mask").agg(F.count("*").alias("n")))
    first = each.groupBy("digest").agg(F.min("_id").alias("_id")).withColumn("first", F.lit(True))
    each = each.join(first, ["digest", "_id"], "left").join(stored(known), "_id", "left")
    later = F.col("_id").isNotNull() & F.col("first").isNull()
    mask = F.col("mask") + F.when(later, 1 << FILTERS.index("E")).otherwise(0)
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    return each.select("part", mask.alias("mask"), *flags, "n").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def potentials(worth: np.ndarray) -> np.ndarray:
    """60 times the potential of each coalition (columns: bit sets), from the worth of each.

    P(S) = (worth(S) + sum over the filters i of S of P(S without i)) / |S|, P of none = 0; 60 = lcm(1 .. 5) keeps it whole.
    """
    out = np.zeros_like(worth)
    for s in sorted(range(1, worth.shape[1]), key=int.bit_count):
        out[:, s] = (60 * worth[:, s] + sum(out[:, s & ~(1 << i)] for i in range(len(FILTERS)) if s >> i & 1)) // s.bit_count()
    return out


def audit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step; see the module for the columns' meaning.

    ``labels`` (``id``, ``quality``, ``toxic``): a document is good or toxic if any row of its id says so; ids without a
    label are neither.  Null texts are empty and equal each other; null parts are the empty string; rows without an
    id are counted and never fail E; rows that repeat with one id all stay; an empty table gives an empty table;
    other columns are not read.
    """
    counts = judged(docs, labels, id, text, part)
    whole = range(_ALL + 1)
    sums = []
    for name, of in (("n", F.col("n")), ("good", F.when(F.col("good"), F.col("n"))), ("toxic", F.when(F.col("toxic"), F.col("n")))):
        sums.append(F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, of)), F.lit(0)) for m in whole]).alias(f"by_{name}"))
    orders = ["".join(p) for p in permutations(FILTERS)]
    # Of each step: the coalition before it, and its filter.
    before = np.array([[sum(1 << FILTERS.index(f) for f in o[:k]) for k in range(len(FILTERS))] for o in orders]).ravel()
    own = np.array([[FILTERS.index(f) for f in o] for o in orders]).ravel()
    removes = np.array([[int(m & s != 0) for s in whole] for m in whole], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                held = [np.array(rows.column(c).to_pylist(), np.int64).reshape(rows.num_rows, -1) for c in ("by_n", "by_good", "by_toxic")]
                worth, good, toxic = (h @ removes for h in held)
                whole_potential = potentials(worth)
                shares = np.stack([2 * (whole_potential[:, _ALL] - whole_potential[:, _ALL & ~(1 << i)]) for i in range(len(FILTERS))], axis=1)
                alone = np.stack([worth[:, 1 << i] for i in range(len(FILTERS))], axis=1)
                only = np.stack([worth[:, _ALL] - worth[:, _ALL & ~(1 << i)] for i in range(len(FILTERS))], axis=1)
                after = before | 1 << own
                removed = worth[:, after] - worth[:, before]
                columns = [held[0].sum(axis=1, keepdims=True) - worth[:, after], removed, alone[:, own] - removed, only[:, own],
                           good[:, after] - good[:, before], toxic[:, after] - toxic[:, before], shares[:, own]]
                n = rows.num_rows
                yield pa.RecordBatch.from_arrays(
                    [rows.column("part").take(pa.array(np.repeat(np.arange(n), len(own)))), pa.array(np.tile(np.repeat(orders, len(FILTERS)), n).tolist(), pa.string()),
                     pa.array(np.tile(np.arange(1, len(FILTERS) + 1), len(orders) * n).astype(np.int32)), *(pa.array(c.ravel()) for c in columns)],
                    names=["part", "filter_order", "step", *_COUNTS])

    return counts.groupBy("part").agg(*sums).mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in _COUNTS))


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

_SQL = r"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), l as (
  select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic from labels group by doc_id
), f as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    (case when len(w) < 50 then 1 else 0 end)
    + (case when 100 * len(list_distinct(w)) < 65 * len(w) then 2 else 0 end)
    + (case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 4 else 0 end)
    + (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end)
    + (case when d.doc_id > min(d.doc_id) over (partition by t) then 16 else 0 end) as mask
  from d left join l on d.doc_id = l.doc_id
), m as (
  select part, mask, count(*) as n, count(*) filter (where good) as g, count(*) filter (where toxic) as x from f group by all
), a as (select unnest(['A', 'B', 'C', 'D', 'E']) as f, unnest([1, 2, 4, 8, 16]) as bit),
o as (
  select a.f || b.f || c.f || d.f || e.f as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from a, a b, a c, a d, a e
  where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31
), s as (
  select filter_order, step, bits[step] as own, coalesce(list_sum(bits[1:step - 1]), 0)::int as before
  from o, (select unnest([1, 2, 3, 4, 5]) as step)
), r as (
  select part, filter_order, step, own,
    sum(case when mask & (before | own) = 0 then n else 0 end) as kept,
    sum(case when mask & before = 0 and mask & own > 0 then n else 0 end) as removed,
    sum(case when mask & before > 0 and mask & own > 0 then n else 0 end) as redundant,
    sum(case when mask = own then n else 0 end) as unique_fails,
    sum(case when mask & before = 0 and mask & own > 0 then g else 0 end) as good_lost,
    sum(case when mask & before = 0 and mask & own > 0 then x else 0 end) as toxic_lost
  from m, s group by all
)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, own))::bigint as shapley
from r
"""


@query("op12_filter_audit", _SQL)
def op12(t):
    """What each filter removes in every order, by source."""
    return audit(t.documents, t.labels)
