"""Near-duplicates by the exact Jaccard similarity of word shingles, through a prefix join.

Shingles have one order for all texts.  Two texts at least ``percent`` similar share a shingle among the first
``n - ceil(percent * n) + 1`` of each, so an equality join on these prefixes finds every pair; the sets of each
candidate pair are then compared.  Shingles that are frequent in a sample of the texts come last in the order,
which keeps them out of most prefixes; the order changes the work and not the links.  The parities of the
shingles in 256 buckets bound the difference of two sets from below; pairs beyond it are not compared.  Those
in twice as many buckets as a text has shingles leave hardly any other pair, so few texts are moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.llm.batches import batch_of, slices
from regweave.llm.components import components
from regweave.session import stored

#: Words of a shingle, and the similarity of a link in per cent.
WORDS, PERCENT = 5, 80
#: One text in so many gives the frequent shingles: those in so many of its texts, at most so many of them.
SAMPLED, FREQUENT, HELD = 32, 4, 200_000
PARITIES = ("p0", "p1", "p2", "p3")
#: Buckets of a sketch for each shingle, at least.
LOAD = 2


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a lower-cased (A-Z) UTF-8 text; a short text is one."""
    got = text.lower().split()
    if not got:
        return np.empty(0, np.int64)
    joined = b" ".join(got)
    if len(got) <= words:
        return np.array([xxhash.xxh64_intdigest(joined)], np.uint64).view(np.int64)
    ends = np.cumsum([len(w) + 1 for w in got])
    starts = [0, *ends[:-1].tolist()]
    hashes = [xxhash.xxh64_intdigest(joined[a:b]) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())]
    return np.unique(np.array(hashes, np.uint64).view(np.int64))


def sketch(keys: np.ndarray) -> bytes:
    """Parities of the shingles in buckets by their last bits: a power of two of buckets, ``LOAD`` a shingle and more."""
    buckets = max(256, 1 << (LOAD * len(keys) - 1).bit_length())
    return np.packbits(np.bincount(keys & (buckets - 1), minlength=buckets) & 1, bitorder="little").tobytes()


def differing(one: bytes, other: bytes) -> int:
    """Buckets of different parity in two sketches, the longer one folded; the sets differ in as many shingles or more."""
    n = min(len(one), len(other))
    bits = 0
    for x in (one, other):
        for at in range(0, len(x), n):
            bits ^= int.from_bytes(x[at : at + n], "little")
    return bits.bit_count()


def _nodes(texts: list[bytes]) -> pa.Array:
    """A hash of the lower-cased words of each text."""
    return pa.array(np.array([xxhash.xxh64_intdigest(b" ".join(t.lower().split())) for t in texts], np.uint64).view(np.int64))


def with_node(docs: DataFrame, column: str, text: str = "text") -> DataFrame:
    """``docs`` with a hash of the lower-cased words of ``text`` in ``column`` and without ``text``, which Python does not give back."""
    docs = docs.drop(column)
    kept = docs.drop(text).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, text, size=2_000_000):
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept.names), _nodes(texts)], names=[*kept.names, column])

    return docs.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{column}` bigint"]))


def _frequent(texts: DataFrame, words: int) -> list[tuple[int, int]]:
    """(shingle, texts of the sample that have it), most frequent first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in slices(batches, "text", size=2_000_000):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([shingles(t, words) for t in part]))], names=["key"])

    some = texts.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0).select("text").mapInArrow(run, "key bigint")
    some = some.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= FREQUENT)
    return [(r.key, r.n) for r in some.orderBy(F.desc("n"), "key").limit(HELD).collect()]  # bounded by HELD


def prefixes(texts: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``key``, ``node``, ``size`` (distinct shingles of the text) and ``at`` (place in their order) of every shingle in a text's prefix.

    The first row of each text has its ``p0`` to ``p3`` (parities) and ``sketch`` too; in the others they are null.
    """
    known = sorted(_frequent(texts, words))
    held = texts.sparkSession.sparkContext.broadcast((np.array([k for k, _ in known], np.int64), np.array([n for _, n in known], np.int64)))
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("size", pa.int32()), ("at", pa.int32()), *((p, pa.int64()) for p in PARITIES), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = held.value
        for _, each in slices(batches, "text", size=2_000_000):
            sets = [shingles(t, words) for t in each]
            sizes = np.array([len(s) for s in sets], np.int64)
            many = np.where(sizes > 0, sizes - -(-percent * sizes // 100) + 1, 0)
            some = sizes > 0
            odd = np.array([np.packbits(np.bincount(s & 255, minlength=256) & 1).view(np.int64) for s in sets]).reshape(-1, 4)
            sketches = pa.array([sketch(s) for s in sets if len(s)], pa.binary())
            for i, s in enumerate(sets):
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                    s = s[np.argsort(np.where(keys[at] == s, counts[at], 0), kind="stable")]
                sets[i] = s[: many[i]]
            node = _nodes(each).to_numpy()
            # Row of a text for each row of the output, null but for the text's first.
            own = np.zeros(many.sum(), np.int64)
            own[(np.cumsum(many) - many)[some]] = np.arange(1, some.sum() + 1)
            own = pa.array(own - 1, mask=own == 0)
            places = pa.array((np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)).astype(np.int32))
            yield batch_of(schema, pa.array(np.concatenate(sets)), pa.array(np.repeat(node, many)), pa.array(np.repeat(sizes, many).astype(np.int32)), places,
                           *[pa.array(p[some]).take(own) for p in odd.T], sketches.take(own))

    columns = ["key bigint", "node bigint", "size int", "at int", *(f"{p} bigint" for p in PARITIES), "sketch binary"]
    return texts.select("text").mapInArrow(run, ", ".join(columns))


def _with_both(pairs: DataFrame, nodes: DataFrame, columns: tuple) -> DataFrame:
    """``a``-``b`` pairs with ``columns`` of both nodes, named after the side."""
    for x in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}{x}") for c in columns]), x)
    return pairs


def _even(percent: int) -> Column:
    """Whether sizes and parities of both sides leave a pair open."""
    differ = sum((F.bit_count(F.col(f"{p}a").bitwiseXOR(F.col(f"{p}b"))) for p in PARITIES), F.lit(0))
    return (100 + percent) * differ <= (100 - percent) * (F.col("sizea") + F.col("sizeb"))


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The ``a``-``b`` pairs that the sizes, parities and sketches of their nodes leave open."""
    pairs = _with_both(pairs, nodes, ("size", *PARITIES)).filter(100 * F.least("sizea", "sizeb") >= percent * F.greatest("sizea", "sizeb"))
    pairs = stored(pairs.filter(_even(percent)).select("a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ones in slices(batches, "sketcha"):
            differ = np.array([differing(x, y.as_py()) for x, y in zip(ones, part.column("sketchb"))], np.int64)
            both = part.column("sizea").to_numpy().astype(np.int64) + part.column("sizeb").to_numpy()
            yield part.select(["a", "b"]).filter(pa.array((100 + percent) * differ <= (100 - percent) * both))

    return _with_both(pairs, nodes, ("size", "sketch")).mapInArrow(run, "a bigint, b bigint")


def similar(pairs: DataFrame, texts: DataFrame, named: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The ``a``-``b`` pairs whose shingle sets are at least ``percent`` similar; only one text of each of their nodes is moved.

    ``texts`` has ``key`` and ``text``, ``named`` the ``key`` and ``node`` of every text.
    """
    pairs = stored(pairs)
    need = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    need = stored(named.join(need, "node").groupBy("node").agg(F.min("key").alias("key")))
    texts = stored(texts.join(need, "key").groupBy("node").agg(F.first("text").alias("text")))
    rows = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    rows = rows.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[bytes, np.ndarray] = {}

        def of(text: bytes) -> np.ndarray:
            if text not in last:
                if len(last) >= 64:
                    last.pop(next(iter(last)))
                last[text] = shingles(text, words)
            return last[text]

        for part, ones in slices(batches, "ta", rows=256, size=2_000_000):
            ok = []
            for one, other in zip(ones, part.column("tb").cast(pa.binary()).to_pylist()):
                x, y = of(one), of(other)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return rows.mapInArrow(run, "a bigint, b bigint")


def _apart(met: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows of ``met`` whose ``key`` holds nodes of several components of ``edges``, with ``_root``."""
    met = met.join(components(edges).withColumnRenamed("root", "_root"), "node", "left").withColumn("_root", F.coalesce("_root", "node"))
    apart = met.groupBy("key").agg(F.min("_root").alias("lo"), F.max("_root").alias("hi")).filter("lo <> hi").select("key")
    return stored(met.join(apart, "key"))


def _meeting(one: DataFrame, other: DataFrame, percent: int) -> DataFrame:
    """``a``-``b`` pairs of different components that meet in a ``key`` which can be the first that a similar pair shares.

    Such a pair shares no shingle before that one, so all that it shares lies from there on in both orders.
    """
    one, other = (x.select("key", *[F.col(c).alias(f"{c}{y}") for c in ("node", "size", "at", "_root", *PARITIES)]) for x, y in ((one, "a"), (other, "b")))
    rest = F.least(F.col("sizea") - F.col("ata"), F.col("sizeb") - F.col("atb"))
    met = one.join(other, "key").filter("_roota <> _rootb").filter(100 * F.least("sizea", "sizeb") >= percent * F.greatest("sizea", "sizeb"))
    met = met.filter((100 + percent) * rest >= percent * (F.col("sizea") + F.col("sizeb"))).filter(_even(percent))
    return met.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b"))


def links(texts: DataFrame, named: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Edges ``a``-``b`` whose components are those of all pairs of ``node`` at least ``percent`` similar.

    ``texts`` and ``named`` are those of ``similar``; a node may have several rows in both.  Every edge is a link.
    The texts of a prefix shingle are first compared with the smallest of them, and in pairs only where that has left
    them in different components and the shingle can be the first that both share, so near copies give no square.
    """
    keyed = stored(prefixes(texts, words, percent))
    nodes = stored(keyed.filter("sketch is not null").drop("key", "at").distinct())
    first = keyed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("last")).filter("a <> last").drop("last")
    met = stored(keyed.join(first, "key").select("key", "node", "size", "at", "a").distinct())
    pairs = met.filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    stars = stored(similar(_possible(pairs, nodes, percent), texts, named, words, percent))
    # The smallest of a shingle has been compared with the others.
    left = _apart(met.filter("node <> a").drop("a").join(nodes.select("node", *PARITIES), "node"), stars)
    pairs = _meeting(left, left, percent).filter("a < b").distinct()
    return stars.unionByName(similar(_possible(pairs, nodes, percent), texts, named, words, percent))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``id``, ``node``, ``root`` and ``component`` of every row: the smallest ``node`` and id reachable over links.

    Texts with the same words are one node, null and empty texts among them; a null id is never the smallest
    unless all are null; repeated rows are kept; other columns are not read; an empty table gives an empty table.
    """
    texts = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("text")).withColumn("key", F.xxhash64("text"))
    # Rows go through Python once for their nodes; from here on texts are told apart by a hash that Spark computes.
    rows = stored(with_node(texts, "node"))
    nodes = stored(rows.groupBy("node").agg(F.min("_id").alias("_least")))
    roots = components(links(texts.select("key", "text"), rows.select("key", "node"), words, percent))
    labelled = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = labelled.groupBy("root").agg(F.min("_least").alias("component"))
    return rows.join(labelled.select("node", "root"), "node").join(classes, "root").select(F.col("_id").alias(id), "node", "root", "component")
