"""Sharding by minimax contiguous partition, with DataFrame operations only.

Groups (equal texts) are the atoms, ordered by a hash.  The smallest capacity that lets a greedy walk put the
ordered groups into the shards is found by binary search.  The walk needs the sizes of single groups only near
the possible cuts, so the search runs over a histogram of the order that is refined there, level by level.  The
driver gets 2^12 buckets, and 2^6 for each refined one: fewer than 2^11 heavy ones a level, then those in the windows
of the cuts, which are at most shards^2 buckets of a 2^11th wide; the groups' number does not enter.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regweave.llm.catalog import query
from regweave.session import stored

#: Bits of the order hash, of the first histogram and of each refinement.
ORDER_BITS, FIRST_BITS, MORE_BITS = 63, 12, 6
#: A bucket of several groups with more than one byte in so many is refined before any cut is looked for.
HEAVY = 2048


def order_of(text: Column) -> Column:
    """Order of a text's group: 63 bits.  Texts that share a value stay together, as equal texts do."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - ORDER_BITS)


def greedy(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """Cuts (indices after the last atom) of the greedy walk over running sizes, None if shards run out."""
    cuts, at, done = [], 0, 0
    for _ in range(shards):
        i = bisect_right(ends, done + capacity)
        if i == at and at < len(ends):
            return None
        cuts.append(i)
        at, done = i, ends[i - 1] if i else 0
        if at == len(ends):
            return cuts
    return None


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Smallest capacity with which the greedy walk succeeds."""
    ends, total = [], 0
    for s in sizes:
        total += s
        ends.append(total)
    lo, hi = max([*sizes, -(-total // shards), 0]), total
    while lo < hi:
        mid = (lo + hi) // 2
        if greedy(ends, mid, shards) is None:
            lo = mid + 1
        else:
            hi = mid
    return lo


def even_cuts(ends: list[int], capacity: int, shards: int) -> list[int]:
    """Cuts within the capacity, each as near to an even split as the walk to its right allows."""
    n, total = len(ends), ends[-1] if ends else 0
    latest = [n]  # from the right: the first atom index at which the last k shards can start
    for _ in range(shards - 1):
        after = ends[latest[-1] - 1] if latest[-1] else 0
        start = bisect_right(ends, after - capacity - 1)
        latest.append(start + 1 if start < n and after - (ends[start - 1] if start else 0) > capacity else start)
    cuts, done = [], 0
    for k in range(1, shards):
        most = bisect_right(ends, done + capacity)
        least = max(cuts[-1] if cuts else 0, latest[shards - k])
        aim = total * k / shards
        i = bisect_right(ends, aim)
        if i < n and ends[i] - aim < aim - (ends[i - 1] if i else 0):
            i += 1
        i = min(max(i, least), max(most, least))
        cuts.append(i)
        done = ends[i - 1] if i else 0
    return cuts


#: (first order value, bytes, groups, bits) of one bucket of the histogram.
Piece = tuple[int, int, int, int]


def _histogram(groups: DataFrame, bits: int, inside: tuple[int, list[int]] | None = None) -> list[Piece]:
    """Buckets of ``2 ** bits`` order values; with ``inside`` = (bits, numbers) only those within these wider buckets."""
    if inside is not None:
        groups = groups.filter(F.expr(f"shiftright(`order`, {ORDER_BITS - inside[0]}) IN ({', '.join(map(str, inside[1]))})"))
    width = ORDER_BITS - bits
    bucket = F.shiftright("order", width).alias("b")
    rows = groups.groupBy(bucket).agg(F.sum("bytes"), F.count("*"), F.min("order")).collect()
    return sorted((r[3] if r[2] == 1 else r[0] << width, r[1], r[2], bits) for r in rows)


def _refined(groups: DataFrame, pieces: list[Piece], split: list[int]) -> list[Piece]:
    """The pieces with those at ``split`` replaced by finer buckets, each from its own width on."""
    gone, wider = set(split), {}
    for i in split:
        bits = pieces[i][3]
        wider.setdefault(bits, []).append(pieces[i][0] >> (ORDER_BITS - bits))
    finer = [p for bits, numbers in sorted(wider.items()) for p in _histogram(groups, min(ORDER_BITS, bits + MORE_BITS), (bits, numbers))]
    return sorted([p for i, p in enumerate(pieces) if i not in gone] + finer)


def _windows(pieces: list[Piece], shards: int, low: int, high: int) -> list[tuple[int, int]]:
    """Size positions between which each cut of any walk with a capacity from ``low`` to ``high`` lies."""
    ends, total = [], 0
    for p in pieces:
        total += p[1]
        ends.append(total)
    out, at = [], 0
    for k in range(1, shards):
        i = bisect_right(ends, at + low)
        at = max(at, ends[i - 1] if i else 0)
        even = total * k // shards
        out.append((min(at, even, max(0, total - (shards - k) * high)), min(total, max(k * high, even))))
    return out


def plan(groups: DataFrame, shards: int) -> tuple[list[int], list[int], int]:
    """Order values of groups with a shard of their own, first order values of shards 2.. among the rest, capacity.

    A group above the even share takes a shard for itself, largest first; the others are cut in order.
    """
    top = groups.orderBy(F.desc("bytes"), "order").select("order", "bytes").limit(shards - 1).collect()
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone: list[int] = []
    rest, left = total, shards
    for r in top:
        if left == 1 or r.bytes * left <= rest:
            break
        alone.append(r.order)
        rest, left = rest - r.bytes, left - 1
    if alone:
        groups = groups.filter(~F.col("order").isin(alone))
    pieces = _histogram(groups, FIRST_BITS)
    if not pieces:
        return alone, [], 0
    while True:
        # Heavy buckets first: they would widen the windows, and fewer than HEAVY of them can exist.
        split = [i for i, (_, size, n, bits) in enumerate(pieces) if n > 1 and bits < ORDER_BITS and size * HEAVY > rest]
        if not split:
            high = smallest_capacity([p[1] for p in pieces], left)
            low = max([-(-rest // left), *(p[1] for p in pieces if p[2] == 1)])
            windows, end = _windows(pieces, left, low, high), 0
            for i, (_, size, n, bits) in enumerate(pieces):
                start, end = end, end + size
                if n > 1 and bits < ORDER_BITS and any(start < hi and end > lo for lo, hi in windows):
                    split.append(i)
        if not split:
            break
        # Buckets that no cut can fall into stay whole.
        pieces = _refined(groups, pieces, split)
    sizes = [p[1] for p in pieces]
    capacity, ends, running = smallest_capacity(sizes, left), [], 0
    for s in sizes:
        running += s
        ends.append(running)
    cuts = even_cuts(ends, capacity, left)
    return alone, [pieces[c][0] if c < len(pieces) else (1 << ORDER_BITS) - 1 for c in cuts], capacity


def shard(docs: DataFrame, shards: int = 16, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every row; equal texts share a shard.

    Size is the bytes of the text plus one.  No shard is larger than the even share plus the largest group that
    is below it, or than a single group above it.  Null and empty texts are one group of size one per row and
    have checksum 0; null ids and repeated rows are kept and get slots of their own; shards may stay empty
    where groups are few; an empty table gives an empty table; other columns are not read.
    """
    # What is known of a row without its text; 'slots' deals rows of any group out evenly.
    text_ = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(id), F.octet_length(text_).cast("bigint").alias("_b"), order_of(text_).alias("order"), F.crc32(text_).alias("text_crc32"))
    rows = stored(rows.withColumn("size", F.col("_b") + 1).drop("_b"))
    groups = stored(rows.groupBy("order").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")))
    alone, firsts, _ = plan(groups, shards)
    number = F.lit(len(alone))
    for i, first in enumerate(firsts):
        number = F.when(F.col("order") >= first, len(alone) + i + 1).otherwise(number)
    for i, order in enumerate(alone):
        number = F.when(F.col("order") == order, i).otherwise(number)
    n = rows.agg(F.count("*")).first()[0]
    buckets = max(16, n // 200_000)
    rows = rows.withColumn("shard", number.cast("int")).withColumn("_k", F.pmod(F.xxhash64(id, "order"), F.lit(buckets)))
    counts = rows.groupBy("shard", "_k").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "_k", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_k").orderBy(id, "order")
    rows = rows.withColumn("_at", F.row_number().over(inside) - 1).join(counts, ["shard", "_k"])
    return rows.select(id, "size", "text_crc32", "shard", (F.col("_before") + F.col("_at")).alias("slot"))


@query("op2_minimax_shards")
def op2(t):
    """All documents in 16 shards of nearly equal bytes."""
    return shard(t.documents).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                     F.lit(None).cast("int").alias("grown_shard"))
