"""Exact substring dedup with suffix arrays by the difference-cover algorithm.

A byte goes if a 200-byte string that covers it also starts anywhere else.  Suffix sorting every byte of a
corpus would move many times its size, so suffixes that cannot matter are left out first, without loss: each
200-byte string picks its first 64-byte piece with the smallest hash, a choice that depends on the string alone,
so equal strings pick the same piece.  Only pieces that occur twice lead on, with the bytes of the strings that
pick them, and all that share one meet in one task.  There the suffixes are sorted by the difference cover modulo 3 (name
sampled triples, recurse on the names until they tell 200 bytes apart, order the rest by the sample, merge),
and neighbours in suffix order are compared.

A piece with more occurrences than a block holds is not sorted in one task; the digests of its 200-byte strings
are grouped instead, which splits and gives the same answer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.llm.batches import batch_of, slices
from regweave.llm.catalog import query
from regweave.session import stored

#: Bytes of a repeated string; of a picked piece.
LENGTH, PIECE = 200, 64
#: Bytes after which a suffix sort begins; occurrences of a piece from which on digests are grouped instead.
#: BLOCK + MANY * (2 * LENGTH - PIECE) stays far below 3 million, so that names of triples fit in 21 bits.
BLOCK, MANY = 200_000, 2_500
_BITS = 1 << 20


def _sliding(a: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values."""
    size = 1
    while 2 * size <= width:
        a = pick(a[:-size], a[size:])
        size *= 2
    rest = width - size
    return pick(a[: len(a) - rest], a[rest:]) if rest else a


def picked(data: np.ndarray, length: int = LENGTH, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each picked piece, and the first and last start of the strings that pick it.

    A string of ``length`` bytes picks its piece with the smallest hash (ties: the first), so each start of a text
    belongs to one pick, and the starts of a pick are neighbours.
    """
    if len(data) < length:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    step, factor = 1, 0xD6E8FEB86659FD93
    while step < piece:
        h = h[:-step] * np.uint64(factor) + h[step:]
        step, factor = 2 * step, factor * factor % (1 << 64)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    width = length - piece + 1
    least = _sliding(h, width, np.minimum)
    ends = np.zeros(width - 1, np.uint64)
    top = _sliding(np.concatenate([ends, least, ends]), width, np.maximum)
    at = np.flatnonzero(top == h)
    # Starts of equal minimum are a run; runs and picks follow each other in the same order, tied picks share a run.
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    last = np.r_[first[1:] - 1, len(least) - 1]
    tied = np.r_[False, h[at[1:]] == h[at[:-1]]]
    run = np.cumsum(~tied) - 1
    begin = np.where(tied, np.r_[0, at[:-1] + 1], first[run])
    end = np.where(np.r_[tied[1:], False], np.minimum(at, last[run]), last[run])
    some = begin <= end
    return h[at[some]], begin[some], end[some]


def _ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of keys and the keys in that order; a key and a position fit in 64 bits together."""
    bits = np.uint64(max(1, len(keys).bit_length()))
    both = np.sort((keys.astype(np.uint64) << bits) | np.arange(len(keys), dtype=np.uint64))
    return (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), both >> bits


def suffix_ranks(s: np.ndarray, levels: int) -> np.ndarray:
    """Ranks of all suffixes of ``s`` (values 1 .. 2**21 - 2) by the difference cover modulo 3.

    With ``levels`` recursions suffixes are told apart by ``3 ** (levels + 1)`` values at least; suffixes equal
    that far may come in any order.
    """
    n = len(s)
    t = np.concatenate([s, np.zeros(3, s.dtype)]).astype(np.uint64)
    one, two = np.arange(1, n + 1, 3), np.arange(2, n + 1, 3)
    sample = np.concatenate([one, two])
    t = np.concatenate([t, np.zeros(3, np.uint64)])
    triples = (t[sample] << np.uint64(42)) | (t[sample + 1] << np.uint64(21)) | t[sample + 2]
    names, back = np.unique(triples, return_inverse=True)
    rank = back + 1
    if levels and len(names) < len(sample):
        rank = suffix_ranks(np.concatenate([rank[: len(one)], [0], rank[len(one) :]]), levels - 1)
        rank = np.delete(rank, len(one)) + 1
    # The sample in order, with distinct places; r holds them by position.
    order, _ = _ordered(rank)
    place = np.empty(len(sample), np.int64)
    place[order] = np.arange(len(sample))
    r = np.zeros(n + 6, np.uint64)
    r[sample] = rank.astype(np.uint64) + np.uint64(1)
    zero = np.arange(0, n, 3)
    by_one = lambda p: (t[p] << np.uint64(21)) | r[p + 1]
    by_two = lambda p: (t[p] << np.uint64(42)) | (t[p + 1] << np.uint64(21)) | r[p + 2]
    z2, k2 = by_two(zero), by_two(two)
    (zeros, z1), (ones, k1) = _ordered(by_one(zero)), _ordered(by_one(one))
    twos = order[order >= len(one)] - len(one)
    # Merge: how many of the sample stand before each other suffix, and the other way round; looked up in order.
    before_zero, rest = np.empty(len(zero), np.int64), np.empty(len(zero), np.int64)
    before_zero[zeros] = np.searchsorted(k1, z1, side="right") + np.searchsorted(np.sort(k2), z2[zeros], side="right")
    rest[zeros] = np.arange(len(zero))
    before_one, before_two = np.empty(len(one), np.int64), np.empty(len(two), np.int64)
    before_one[ones] = np.searchsorted(z1, k1, side="left")
    before_two[twos] = np.searchsorted(np.sort(z2), k2[twos], side="left")
    out = np.empty(n + 1, np.int64)
    out[zero] = rest + before_zero
    out[one] = place[: len(one)] + before_one
    out[two] = place[len(one) :] + before_two
    return out[:n]


def repeated_starts(text: np.ndarray, starts: np.ndarray, where: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which of ``starts`` begin ``length`` bytes that another place has too; ``where`` tells places apart."""
    levels, reach = 0, 3
    while reach < length:
        levels, reach = levels + 1, reach * 3
    ranks = suffix_ranks(text.astype(np.int64) + 1, levels)
    order, _ = _ordered(ranks[starts])
    at = starts[order]
    words = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for shift in (1, 2, 4):
        words = (words[:-shift] << np.uint64(8 * shift)) | words[shift:]
    same = np.ones(len(at) - 1, bool)
    for o in [*range(0, length - 7, 8), length - 8]:
        live = np.flatnonzero(same)
        same[live] = words[at[live] + o] == words[at[live + 1] + o]
    run = np.concatenate([[0], np.cumsum(~same)])
    first = np.flatnonzero(np.r_[True, ~same])
    w = where[order]
    several = np.minimum.reduceat(w, first) != np.maximum.reduceat(w, first)
    out = np.zeros(len(starts), bool)
    out[order] = several[run]
    return out


def intervals_of(left: list[tuple], length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """(k1, k2, start, end) of repeated bytes in the single ones of contexts ``(piece, single, k1, k2, start, bytes)``."""
    out = []
    left = [(context, (k1, k2, start), single) for _, single, k1, k2, start, context in left]
    text = np.frombuffer(b"".join(c for c, _, _ in left), np.uint8)
    sizes = np.array([len(c) for c, _, _ in left])
    heads = np.cumsum(sizes) - sizes
    fits = sizes - length + 1
    owner = np.repeat(np.arange(len(left)), fits)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(fits) - fits, fits)
    numbers: dict[tuple[int, int], int] = {}
    key = np.array([numbers.setdefault(p[:2], len(numbers)) for _, p, _ in left])
    begin = np.array([p[2] for _, p, _ in left])
    where = (key[owner] << 40) + begin[owner] + offset
    hit = repeated_starts(text, heads[owner] + offset, where, length)
    hit &= np.array([single for _, _, single in left])[owner]
    at = np.flatnonzero(hit)
    if len(at):
        new = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (np.diff(owner[at]) > 0)])
        last = np.r_[new[1:], len(at)] - 1
        for a, b in zip(at[new].tolist(), at[last].tolist()):
            _, (k1, k2, start), _ = left[owner[a]]
            out.append((k1, k2, start + int(offset[a]), start + int(offset[b]) + length))
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted union of spans; touching ones become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _only(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` without most rows whose ``k1`` is not in ``wanted``, by a bitmap of fixed size."""
    bit = F.pmod("k1", F.lit(_BITS)) + 1
    rows = wanted.groupBy(F.bitmap_bucket_number(bit).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("m")).collect()
    maps = np.zeros((_BITS // 32768, 4096), np.uint8)  # 128 kB, whatever the rows
    for r in rows:
        maps[r.b - 1] = np.frombuffer(r.m, np.uint8)
    held = docs.sparkSession.sparkContext.broadcast(np.unpackbits(maps.reshape(-1), bitorder="little").astype(bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(held.value[batch.column("k1").to_numpy() % _BITS]))

    return docs.mapInArrow(run, docs.schema)


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, piece: int = PIECE, many: int = MANY, block: int = BLOCK) -> DataFrame:
    """``k1 k2`` (two hashes of a text), ``start`` and ``end`` of repeated bytes of distinct texts; spans may overlap.

    Copies of whole texts count as one text here.
    """
    keyed = docs.filter(F.octet_length(text) >= length).select(F.col(text).cast("string").alias("text"))
    keyed = keyed.select("text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("piece", pa.int64()), ("context", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int32()), ("size", pa.int32())])
        for part, texts in slices(batches, "text"):
            got = [picked(np.frombuffer(t, np.uint8), length, piece) for t in texts]
            counts = [len(h) for h, _, _ in got]
            k1, k2 = np.repeat(part.column("k1").to_numpy(), counts), np.repeat(part.column("k2").to_numpy(), counts)
            starts, ends = [a for _, a, _ in got], [b + length for _, _, b in got]
            hashes = [xxhash.xxh64_intdigest(t[a:b]) for t, s, e in zip(texts, starts, ends) for a, b in zip(s.tolist(), e.tolist())]
            start, end = np.concatenate(starts).astype(np.int32), np.concatenate(ends).astype(np.int32)
            yield batch_of(schema, np.concatenate([h for h, _, _ in got]).view(np.int64), np.array(hashes, np.uint64).view(np.int64), k1, k2, start, end - start)

    pieces = stored(keyed.mapInArrow(pick, "piece bigint, context bigint, k1 bigint, k2 bigint, start int, size int"))
    # Equal contexts of a piece are one class.  A class with two places is repeated as a whole; a class with one
    # place needs the suffix sort if its piece has other classes.  Copies of a text are one place.
    place = F.xxhash64("k1", "k2", "start")
    classes = pieces.groupBy("piece", "context").agg(*[F.first(c).alias(c) for c in ("k1", "k2", "start", "size")], F.min(place).alias("a"), F.max(place).alias("b"))
    classes = stored(classes.withColumn("single", F.col("a") == F.col("b")).drop("a", "b"))
    whole = pieces.join(classes.filter("not single").select("piece", "context"), ["piece", "context"])
    whole = whole.select("k1", "k2", "start", (F.col("start") + F.col("size")).alias("end"))
    unsure = classes.groupBy("piece").agg(F.count("*").alias("n"), F.sum(F.col("single").cast("int")).alias("n1")).filter("n > 1 and n1 > 0").select("piece", "n")
    met = stored(classes.join(unsure, "piece").select("piece", "n", "k1", "k2", "start", "size", "single"))
    # All places of one text: as many as the text is long, at most.
    places = met.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "size", "piece", "n", "single")).alias("places"))
    one = _only(keyed, met).join(places, ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("text").alias("text"), F.first("places").alias("places"))

    def surround(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("piece", pa.int64()), ("n", pa.int64()), ("single", pa.bool_()), ("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int32()), ("context", pa.binary())])
        for part, texts in slices(batches, "text", rows=256):
            rows = []
            for t, k1, k2, at in zip(texts, part.column("k1").to_pylist(), part.column("k2").to_pylist(), part.column("places").to_pylist()):
                for p in at:
                    a = p["start"]
                    rows.append((p["piece"], p["n"], p["single"], k1, k2, a, t[a : a + p["size"]]))
                    if len(rows) == 4096:
                        yield batch_of(schema, *zip(*rows))
                        rows = []
            if rows:
                yield batch_of(schema, *zip(*rows))

    contexts = one.select("k1", "k2", "text", "places").mapInArrow(surround, "piece bigint, n bigint, single boolean, k1 bigint, k2 bigint, start int, context binary")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("piece", "single", "k1", "k2", "start", "context"))):
                if row[0] != last and size > block:
                    yield batch_of(schema, *(zip(*got) if (got := intervals_of(held, length)) else ([], [], [], [])))
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
                last = row[0]
        if held:
            yield batch_of(schema, *(zip(*got) if (got := intervals_of(held, length)) else ([], [], [], [])))

    spans = "k1 bigint, k2 bigint, start int, `end` int"
    few = contexts.filter(F.col("n") <= many).drop("n").repartition("piece").sortWithinPartitions("piece")
    out = few.mapInArrow(sort, spans).unionByName(whole)
    hot = met.filter(F.col("n") > many)
    if hot.isEmpty():
        return out

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("digest", pa.binary()), ("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int32())])
        for batch in batches:
            rows = []
            for k1, k2, a, c in zip(*(batch.column(x).to_pylist() for x in ("k1", "k2", "start", "context"))):
                rows += [(xxhash.xxh3_128_digest(c[o : o + length]), k1, k2, a + o) for o in range(len(c) - length + 1)]
                if len(rows) > 50_000:
                    yield batch_of(schema, *zip(*rows))
                    rows = []
            if rows:
                yield batch_of(schema, *zip(*rows))

    strings = contexts.filter(F.col("n") > many).drop("n", "piece", "single").mapInArrow(digests, "digest binary, k1 bigint, k2 bigint, start int")
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("k1", "k2", "start") for f in (F.min, F.max)]
    repeated = strings.groupBy("digest").agg(*ends).filter("min_k1 <> max_k1 or min_k2 <> max_k2 or min_start <> max_start").select("digest")
    return out.unionByName(strings.join(repeated, "digest").select("k1", "k2", "start", (F.col("start") + length).cast("int").alias("end")))


def cut_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, **how) -> DataFrame:
    """``id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` of every row.

    Strings are judged on the input; matches never cross texts.  Null and empty texts have nothing to remove; every
    byte of a text of ``length`` bytes or more that another row equals goes, repeated rows among them; null ids
    and ties change nothing; other columns are not read; an empty table gives an empty table.  ``spans`` are the
    removed (start, end) byte ranges.
    """
    text_ = F.coalesce(F.col(text).cast("string"), F.lit(""))
    docs = docs.select(F.col(id).alias("_id"), text_.alias("text"))
    keys = [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2")]
    spans = stored(repeated_spans(docs, "text", length, **how).distinct())
    # One text's spans at most in a list.
    lists = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("sha", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
        for part, texts in slices(batches, "text"):
            shas, runs = [], []
            for t, found in zip(texts, part.column("found").to_pylist()):
                run = merged([(f["start"], f["end"]) for f in found])
                edges = [0, *(x for ab in run for x in ab), len(t)]
                shas.append(hashlib.sha256(b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2]))).hexdigest())
                runs.append([{"start": a, "end": b} for a, b in run])
            yield batch_of(schema, part.column("k1"), part.column("k2"), shas, runs)

    keyed = docs.select("text", *keys)
    fetched = _only(keyed, spans).join(lists, ["k1", "k2"]).select("k1", "k2", "text", "found")
    cuts = fetched.mapInArrow(cut, "k1 bigint, k2 bigint, sha string, spans array<struct<start:int,end:int>>").dropDuplicates(["k1", "k2"])
    rows = docs.select("_id", *keys, F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    copies = rows.groupBy("k1", "k2").agg(F.count("*").alias("copies"))
    rows = rows.join(copies, ["k1", "k2"]).join(cuts, ["k1", "k2"], "left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    all_of_it = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end")))
    none = F.lit([]).cast("array<struct<start:int,end:int>>")
    rows = rows.withColumn("spans", F.when(gone, all_of_it).otherwise(F.coalesce("spans", none)))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return rows.select(F.col("_id").alias(id), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                       F.when(gone, hashlib.sha256().hexdigest()).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"), "spans")


@query("op6_suffix_dedup")
def op6(t):
    """Bytes of every document that 200-byte repeats cover, and a digest of the others."""
    return cut_repeats(t.documents).drop("spans")
