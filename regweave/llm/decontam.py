"""Benchmark decontamination by the q-gram lemma.

A text within ``e`` edits of an item of ``m`` bytes shares at least ``m - q + 1 - q * e`` of its q-grams with
it, on diagonals that differ by at most ``e``.  Shared q-grams are counted in overlapping bands of diagonals;
bands that reach the bound are verified by banded alignment.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.llm.batches import slices
from regweave.llm.catalog import query

#: Bytes of a q-gram; edits allowed per byte of an item; bytes of the items that one pass holds.
Q, EDITS, BLOCK_BYTES = 8, 0.05, 8_000_000
#: Bits of the number of a band; a text has fewer bytes than 2 ** BAND_BITS.
BAND_BITS = 32
_BUILT: dict = {}
_FOLD = bytes(32 if i in b"\t\n\r\f\v" else i + 32 if 65 <= i <= 90 else i for i in range(256))


def fold(text: bytes) -> bytes:
    """A-Z to lower case and white space to spaces; offsets stay."""
    return text.translate(_FOLD)


def grams(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one integer."""
    out = data.astype(np.uint64)
    for shift in (1, 2, 4):
        out = (out[:-shift] << np.uint64(8 * shift)) | out[shift:]
    return out


def align(item: bytes, text: bytes, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place for the whole item in ``text`` on diagonals ``low`` to ``high``.

    Diagonals are text position less item position; ``None`` if more than ``most`` edits are needed.  Ties go to
    the place that ends first.
    """
    width, far = high - low + 1, most + 1
    cost = [0 if 0 <= low + d <= len(text) else far for d in range(width)]
    begin = [low + d for d in range(width)]
    for i, byte in enumerate(item, 1):
        new, at = [far] * width, [0] * width
        for d in range(width):
            j = i + low + d
            if j < 0 or j > len(text):
                continue
            if j > 0:
                new[d], at[d] = cost[d] + (text[j - 1] != byte), begin[d]
                if d and new[d - 1] + 1 < new[d]:
                    new[d], at[d] = new[d - 1] + 1, at[d - 1]
            if d + 1 < width and cost[d + 1] + 1 < new[d]:
                new[d], at[d] = cost[d + 1] + 1, begin[d + 1]
        cost, begin = new, at
        if min(cost) > most:
            return None
    best = min(range(width), key=lambda d: cost[d])
    return (cost[best], begin[best], len(item) + low + best) if cost[best] <= most else None


class Index:
    """q-grams of a block of items; finds their places in texts."""

    def __init__(self, items: list[tuple[object, bytes]], edits: float = EDITS) -> None:
        self.items = [(k, fold(t)) for k, t in items]
        self.longest = max((len(t) for _, t in self.items), default=0)
        self.most = np.array([self.budget(len(t), edits) for _, t in self.items], np.int64)
        self.need = np.array([len(t) - Q + 1 - Q * e for (_, t), e in zip(self.items, self.most)], np.int64)
        # Too short for a q-gram: such items are looked for as they are.
        self.short = [i for i, (_, t) in enumerate(self.items) if 0 < len(t) < Q]
        parts = [(grams(np.frombuffer(t, np.uint8)), i) for i, (_, t) in enumerate(self.items) if len(t) >= Q]
        keys = np.concatenate([g for g, _ in parts]) if parts else np.empty(0, np.uint64)
        item = np.concatenate([np.full(len(g), i, np.int64) for g, i in parts]) if parts else np.empty(0, np.int64)
        at = np.concatenate([np.arange(len(g)) for g, _ in parts]) if parts else np.empty(0, np.int64)
        order = np.argsort(keys, kind="stable")
        self.item, self.at = item[order], at[order]
        self.keys, self.first = np.unique(keys[order], return_index=True)
        self.first = np.append(self.first, len(keys))
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self._slot(self.keys)] = True

    @staticmethod
    def budget(size: int, edits: float) -> int:
        """Edits allowed for an item: the share of its bytes, as far as the bound stays above zero."""
        return max(0, min(int(edits * size), (size - Q) // Q))

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)

    def candidates(self, texts: list[bytes]) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """Diagonal ranges of each (text, item) whose shared q-grams reach the bound."""
        lengths = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(texts), np.uint8)
        if len(data) < Q or not len(self.keys):
            return {}
        keys = grams(data)
        pos = np.flatnonzero(self.seen[self._slot(keys)])
        where = np.searchsorted(self.keys, keys[pos])
        where[where == len(self.keys)] = 0
        hit = self.keys[where] == keys[pos]
        pos, where = pos[hit], where[hit]
        doc = np.searchsorted(starts, pos, side="right") - 1
        inside = pos + Q <= starts[doc] + lengths[doc]
        pos, where, doc = pos[inside], where[inside], doc[inside]
        counts = self.first[where + 1] - self.first[where]
        ends = np.cumsum(counts)
        # Document, item and band as one number; the next band of the same pair is the next number.
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for a, b in self._steps(ends):
            n = counts[a:b]
            owner = np.repeat(np.arange(a, b), n)
            entry = np.arange(len(owner)) - np.repeat(ends[a:b] - n - (ends[a - 1] if a else 0), n) + np.repeat(self.first[where[a:b]], n)
            item = self.item[entry]
            diagonal = pos[owner] - starts[doc[owner]] - self.at[entry]
            band = (diagonal + self.longest) // (self.most[item] + 1)
            parts.append(np.unique(((doc[owner] * len(self.items) + item) << BAND_BITS) + band, return_counts=True))
        if not parts:
            return {}
        key, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        count = np.bincount(back, weights=np.concatenate([c for _, c in parts]), minlength=len(key)).astype(np.int64)
        follows = np.r_[key[1:] == key[:-1] + 1, False]
        more = np.where(follows, np.r_[count[1:], 0], 0)
        pair, band = key >> BAND_BITS, key & ((1 << BAND_BITS) - 1)
        d, i = np.divmod(pair, len(self.items))
        alone = ~follows & ~np.r_[False, follows[:-1]]
        # A band counts with the next one; the last band of a run counts alone.
        keep = np.flatnonzero(count + more >= self.need[i])
        out: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for k in keep.tolist():
            w = int(self.most[i[k]]) + 1
            low = int(band[k]) * w - self.longest
            out.setdefault((int(d[k]), int(i[k])), []).append((low - w, low + (3 if follows[k] or alone[k] else 2) * w))
        return out

    @staticmethod
    def _steps(ends: np.ndarray, most: int = 250_000) -> Iterator[tuple[int, int]]:
        """Runs of hits with a bounded number of entries; a single hit may be larger."""
        a = 0
        while a < len(ends):
            base = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield a, b
            a = b

    def find(self, texts: list[bytes]) -> list[tuple[int, object, int, int, int]]:
        """(text number, item, start, end, edits): one row per place, the best of places that overlap."""
        texts = [fold(t) for t in texts]
        out = []
        for (d, i), ranges in self.candidates(texts).items():
            key, item = self.items[i]
            places = set()
            for low, high in ranges:
                a, b = max(0, low), min(len(texts[d]), high + len(item))
                at = texts[d].find(item, a, b)
                got = (0, at, at + len(item)) if at >= 0 else align(item, texts[d], low, high, int(self.most[i]))
                if got:
                    places.add(got)
            kept: list[tuple[int, int, int]] = []
            for e, a, b in sorted(places):
                if all(b <= x or a >= y for _, x, y in kept):
                    kept.append((e, a, b))
            out += [(d, key, a, b, e) for e, a, b in kept]
        for i in self.short:
            key, item = self.items[i]
            for d, text in enumerate(texts):
                at = text.find(item)
                while at >= 0:
                    out.append((d, key, at, at + len(item), 0))
                    at = text.find(item, at + len(item))
        return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", edits: float = EDITS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per place of a benchmark item in a text: ``id``, ``item_id``, ``start``, ``end`` (bytes), ``edits``.

    The items pass in blocks of bounded bytes, each against all documents.  Null and empty texts and items match
    nothing; items shorter than a q-gram are matched exactly; equal items are reported each; rows that repeat are
    reported each; null ids are kept; empty tables give an empty table; other columns are not read.
    """
    docs = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    items = benchmark.select(F.col(item_id).alias("_item"), F.col(item_text).cast("string").alias("_words")).filter(F.length("_words") > 0)
    item_type = items.schema["_item"].dataType.simpleString()
    schema = f"`{id}` {docs.schema['_id'].dataType.simpleString()}, `{item_id}` {item_type}, start bigint, `end` bigint, edits int"
    total = items.agg(F.sum(F.octet_length("_words"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    out = None
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("_item", "_words"), F.lit(blocks)) == block).orderBy("_item", "_words").collect()
        held = docs.sparkSession.sparkContext.broadcast([(r[0], r[1].encode()) for r in part])

        def run(batches: Iterator[pa.RecordBatch], held=held, name=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            # A worker builds the index of a block once, whatever tasks it gets.
            if _BUILT.get("block") != name:
                _BUILT.update(block=name, index=Index(held.value, edits))
            index = _BUILT["index"]
            for rows, texts in slices(batches, "_text", rows=2048, size=1_000_000):
                found = index.find(texts)
                if found:
                    d, keys, starts, ends, costs = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("_id").take(pa.array(d)), pa.array(keys), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(costs, pa.int32())],
                        names=[id, item_id, "start", "end", "edits"])

        found = docs.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


@query("op10_decontamination")
def op10(t):
    """Every place of a benchmark item in any document."""
    return contaminated(t.documents, t.benchmark).withColumnsRenamed({"start": "span_start", "end": "span_end"})
