"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint is cut into ``k // 2 + 1`` segments, so that of two fingerprints at most ``k`` bits apart one
segment differs by at most one bit.  Each segment is indexed once as it is and once for every bit with that
bit wiped out; an equality join on these variants finds all candidates, and the bit count verifies them.
Variants with many members are joined on a second wildcard in the rest of the fingerprint instead of in
pairs, which is exact too and grows with the members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.llm.batches import slices
from regweave.llm.catalog import query
from regweave.llm.components import components
from regweave.session import stored, unsized

#: Members of a variant from which on pairs are not formed; both ways find the same links.
PAIRED = 64


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a lower-cased (A-Z) UTF-8 text; 0 without words."""
    got = text.lower().split()
    if not got:
        return 0
    joined = b" ".join(got)
    if len(got) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum([len(w) + 1 for w in got])
        starts = [0, *ends[:-1].tolist()]
        hashes = [xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())]
    raw = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(raw), 1 << 16):
        ones += np.unpackbits(raw[at : at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(raw), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """``id`` and ``fp`` (the 64 bits as a signed long) of every row; null and empty texts have fingerprint 0."""
    docs = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "_text", size=2_000_000):
            prints = np.array([fingerprint(t, words, seed) for t in texts], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(prints)], names=["_id", "fp"])

    return docs.mapInArrow(run, f"_id {docs.schema['_id'].dataType.simpleString()}, fp bigint").withColumnRenamed("_id", id)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _explode_masked(df: DataFrame, masks: list[int]) -> DataFrame:
    """``df`` once for each mask: ``v`` its number, ``key`` what is left of ``fp`` under it."""
    pairs = F.array(*[F.struct(F.lit(i).alias("v"), F.lit(_signed(m)).alias("m")) for i, m in enumerate(masks)])
    return df.select("*", F.explode(pairs).alias("_x")).select(*df.columns, F.col("_x.v").alias("v"), F.col("fp").bitwiseAND(F.col("_x.m")).alias("key"))


def variants(k: int) -> list[tuple[int, int | None]]:
    """(bits of the segment, wiped bit or None) of every deletion variant for links of up to ``k`` bits."""
    n = k // 2 + 1
    edges = [round(64 * i / n) for i in range(n + 1)]
    out: list[tuple[int, int | None]] = []
    for lo, hi in zip(edges, edges[1:]):
        segment = (1 << hi) - (1 << lo)
        out += [(segment, None), *((segment, b) for b in range(lo, hi))]
    return out


def differing(a: Column, b: Column) -> Column:
    """Bits in which two fingerprints differ."""
    return F.bit_count(a.bitwiseXOR(b))


def links(prints: DataFrame, k: int = 2, paired: int = PAIRED) -> DataFrame:
    """Edges ``a``-``b`` whose components are those of all links of up to ``k`` bits between distinct ``fp``.

    Every edge is a link; a link that is not an edge itself has both ends on one star of links.
    """
    kinds = variants(k)
    # Every print becomes many rows with keys of their own: it takes many tasks, however small the files of prints are.
    prints = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    index = _explode_masked(prints, [s & ~(1 << b) if b is not None else s for s, b in kinds])
    # A variant with a wiped bit joins those that have the bit with those that do not; equal segments meet
    # in the variant without one.
    wiped = F.array(*[F.lit(0 if b is None else _signed(1 << b)) for _, b in kinds])
    index = index.withColumn("has", F.col("fp").bitwiseAND(F.element_at(wiped, F.col("v") + 1)) != 0)
    whole = F.array(*[F.lit(b is None) for _, b in kinds])
    sizes = index.groupBy("v", "key").agg(F.count("*").alias("n"), F.sum(F.col("has").cast("int")).alias("n1"))
    sizes = sizes.filter(F.when(F.element_at(whole, F.col("v") + 1), F.col("n") > 1).otherwise((F.col("n1") > 0) & (F.col("n1") < F.col("n"))))
    met = stored(unsized(index).join(sizes, ["v", "key"]).select("v", "key", "fp", "has", "n"))
    few = met.filter(F.col("n") <= paired)
    one, other = few.select("v", "key", F.col("fp").alias("a"), F.col("has").alias("ha")), few.select("v", "key", F.col("fp").alias("b"), F.col("has").alias("hb"))
    is_whole = F.element_at(whole, F.col("v") + 1)
    pairs = one.join(other, ["v", "key"]).filter(F.when(is_whole, F.col("a") < F.col("b")).otherwise(~F.col("ha") & F.col("hb")))
    pairs = pairs.filter(differing(F.col("a"), F.col("b")) <= k).select("a", "b")
    return pairs.unionByName(_stars(met.filter(F.col("n") > paired), kinds, k)).distinct()


def _stars(many: DataFrame, kinds: list[tuple[int, int | None]], k: int) -> DataFrame:
    """Links inside variants with many members: equal up to wildcards in the rest, joined to the smallest."""
    out = None
    for segment in sorted({s for s, _ in kinds}):
        rest = [b for b in range(64) if not segment >> b & 1]
        for whole in (True, False):
            picked = [i for i, (s, b) in enumerate(kinds) if s == segment and (b is None) == whole]
            wild = k if whole else k - 1
            masks = [((1 << 64) - 1) & ~sum(1 << b for b in c) & ~segment for c in combinations(rest, wild)]
            members = many.filter(F.col("v").isin(picked)).select(F.col("v").alias("v0"), F.col("key").alias("k0"), "fp")
            keyed = _explode_masked(members, masks)
            centre = keyed.groupBy("v0", "k0", "v", "key").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n")
            edges = unsized(keyed).join(centre, ["v0", "k0", "v", "key"]).filter("fp <> a").select("a", F.col("fp").alias("b")).distinct()
            out = edges if out is None else out.unionByName(edges)
    return out


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 2, words: int = 3) -> DataFrame:
    """``id``, ``fp``, ``root`` and ``component`` of every row: the smallest ``fp`` and id reachable over links of up to ``k`` bits.

    Equal fingerprints are one class, whatever their number.  Null and empty texts have fingerprint 0 and are
    linked like any other; a null id is never the smallest unless all are null; repeated rows are kept; other
    columns are not read; an empty table gives an empty table.
    """
    rows = stored(fingerprints(docs, id, text, words))
    nodes = stored(rows.groupBy("fp").agg(F.min(id).alias("_least")))
    roots = components(links(nodes.select("fp"), k))
    labelled = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    classes = labelled.groupBy("root").agg(F.min("_least").alias("component"))
    return rows.join(labelled.select("fp", "root"), "fp").join(classes, "root").select(id, "fp", "root", "component")


@query("op1_simhash")
def op1(t):
    """Fingerprint and component of every document."""
    out = near_duplicates(t.documents)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
