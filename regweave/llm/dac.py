"""Token-id output as directly addressable codes.

An id is cut into chunks of eight bits.  Level 0 holds the lowest chunk of every token, level ``k`` the next
chunk of the tokens that have one.  A bitmap beside each level says which tokens go on; a rank directory
(set bits before each block of 512) finds a token's place on the next level, so any token, or any range of
tokens, is read without decoding what stands before it.

A *segment* is one such code with a directory of its documents; a file set is a Parquet table of segments in
ascending id order, so it lies in any store that Spark writes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regweave.llm.batches import batch_of, parts_of
from regweave.llm.bpe import Pieces, default_tokenizer, worker_words
from regweave.llm.catalog import query
from regweave.session import shared_folder

BLOCK = 64  # bytes of bitmap per directory entry
MAGIC = b"RWDA"
SEGMENT_TOKENS = 1 << 18


def build(values: np.ndarray) -> bytes:
    """The code of unsigned ids: level count, then per level its length, chunks, bitmap and directory."""
    levels, rest = [], np.asarray(values, np.uint32)
    while True:
        on = rest > 0xFF
        bits = np.packbits(on, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % BLOCK))
        ones = np.bitwise_count(bits).reshape(-1, BLOCK).sum(axis=1, dtype=np.uint32)
        directory = np.concatenate([[0], np.cumsum(ones)]).astype("<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + directory.tobytes())
        rest = (rest >> 8)[on]
        if not len(rest):
            return struct.pack("<I", len(levels)) + b"".join(levels)


class Code:
    """Reader of one code: ``get`` for any positions, ``span`` for a range."""

    def __init__(self, raw: bytes | memoryview) -> None:
        (n,) = struct.unpack_from("<I", raw)
        at, self.levels = 4, []
        for _ in range(n):
            (size,) = struct.unpack_from("<Q", raw, at)
            at += 8
            width = -(-(-(-size // 8)) // BLOCK) * BLOCK
            chunks = np.frombuffer(raw, np.uint8, size, at)
            bits = np.frombuffer(raw, np.uint8, width, at + size)
            directory = np.frombuffer(raw, "<u4", width // BLOCK + 1, at + size + width)
            at += size + width + 4 * (width // BLOCK + 1)
            self.levels.append((chunks, bits, directory))
        self.size = len(self.levels[0][0])

    @staticmethod
    def _rank(level, i: int) -> int:
        """Set bits before position ``i``."""
        _, bits, directory = level
        block, byte = i // (8 * BLOCK), i // 8
        n = int(directory[block]) + int(np.bitwise_count(bits[block * BLOCK : byte]).sum())
        return n + (int(bits[byte]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else n

    def get(self, i: int) -> int:
        """The id at one position."""
        value = shift = 0
        for level in self.levels:
            value |= int(level[0][i]) << shift
            if not level[1][i // 8] >> (i % 8) & 1:
                return value
            i, shift = self._rank(level, i), shift + 8
        return value

    def span(self, start: int, stop: int) -> np.ndarray:
        """The ids of a range: on each level the range is contiguous."""
        out = np.zeros(stop - start, np.uint32)
        where, shift = np.arange(stop - start), 0
        for level in self.levels:
            if stop <= start:
                break
            out[where] |= level[0][start:stop].astype(np.uint32) << np.uint32(shift)
            on = np.unpackbits(level[1][start // 8 : -(-stop // 8)], bitorder="little")[start % 8 :][: stop - start].astype(bool)
            where, shift = where[on], shift + 8
            start, stop = self._rank(level, start), self._rank(level, stop)
        return out


def segment(ids: list[int | None], tokens: list[np.ndarray]) -> bytes:
    """Documents with their ids (null: the smallest 64-bit integer) and the code of all their tokens."""
    ends = np.cumsum([0, *map(len, tokens)]).astype("<u8")
    names = np.array([np.iinfo(np.int64).min if i is None else i for i in ids], "<i8")
    code = build(np.concatenate(tokens) if tokens else np.empty(0, np.uint32))
    return MAGIC + struct.pack("<Q", len(ids)) + names.tobytes() + ends.tobytes() + code


def open_segment(raw: bytes) -> tuple[list[int | None], np.ndarray, Code]:
    """Ids, document bounds and the code of a segment."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token segment")
    (n,) = struct.unpack_from("<Q", raw, 4)
    names = np.frombuffer(raw, "<i8", n, 12)
    ends = np.frombuffer(raw, "<u8", n + 1, 12 + 8 * n)
    null = np.iinfo(np.int64).min
    return [None if i == null else int(i) for i in names], ends.astype(np.int64), Code(memoryview(raw)[12 + 8 * n + 8 * (n + 1) :])


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, id: str = "doc_id", text: str = "text", end_id: int = 1,
                 segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode whole texts, append ``end_id`` to each, and write segments in ascending id order.

    Null ids come first, rows with equal ids in the order of a hash of their texts; null and empty texts hold the
    end id alone; an empty table writes an empty table.  ``id`` must be an integer; other columns are not read.
    A segment holds whole documents, up to ``segment_tokens`` tokens or one document if that is longer.
    """
    path = path or default_tokenizer()
    rows = docs.select(F.col(id).cast("bigint").alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    # Texts are put in order before they are encoded, or finding the ranges would encode them once more.
    rows = rows.withColumn("_tie", F.xxhash64("_text"))
    rows = rows.repartitionByRange("_id", "_tie").sortWithinPartitions("_id", "_tie").drop("_tie").withColumn("part", F.spark_partition_id())
    end = np.array([end_id], np.uint32)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("seg", pa.int32()), ("n_tokens", pa.int64()), ("n_docs", pa.int64()), ("data", pa.binary())])
        names, held, size, seg, part, words = [], [], 0, 0, 0, worker_words(path, False)
        for rows in parts_of(batches, "_text"):
            ids, bounds, _ = words.encode(Pieces(rows.column("_text")))
            at = bounds.tolist()
            for p, i, a, b in zip(rows.column("part").to_pylist(), rows.column("_id").to_pylist(), at, at[1:]):
                part, doc = p, np.concatenate([ids[a:b], end])
                if names and size + len(doc) > segment_tokens:
                    yield batch_of(schema, [part], [seg], [size], [len(names)], [segment(names, held)])
                    names, held, size, seg = [], [], 0, seg + 1
                names.append(i)
                held.append(doc)
                size += len(doc)
        if names:
            yield batch_of(schema, [part], [seg], [size], [len(names)], [segment(names, held)])

    out = rows.mapInArrow(pack, "part int, seg int, n_tokens bigint, n_docs bigint, data binary")
    out.write.option("compression", "zstd").parquet(folder)


def read_documents(spark: SparkSession, folder: str, digest=lambda ids: zlib.crc32(ids.astype("<u4").tobytes())) -> DataFrame:
    """``doc_id``, ``start`` (tokens of all documents before), ``n_tokens`` and a digest of each document's ids."""
    files = spark.read.parquet(folder)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("seg", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("digest", pa.int64())])
        for batch in batches:
            for p, s, raw in zip(batch.column("part").to_pylist(), batch.column("seg").to_pylist(), batch.column("data")):
                names, ends, code = open_segment(raw.as_py())
                bounds = ends.tolist()
                digests = [digest(code.span(a, b)) for a, b in zip(bounds, bounds[1:])]
                yield batch_of(schema, [p] * len(names), [s] * len(names), names, bounds[:-1], np.diff(ends).tolist(), digests)

    # Two small prefix sums: over the parts of the table, and over the segments of each part.
    sizes = files.select("part", "seg", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_part"))
    inside = Window.partitionBy("part").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.withColumn("_seg", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).drop("n_tokens").join(parts, "part")
    docs = files.select("part", "seg", "data").mapInArrow(unpack, "part int, seg int, doc_id bigint, at bigint, n_tokens bigint, digest bigint")
    return docs.join(base, ["part", "seg"]).select("doc_id", (F.col("_part") + F.col("_seg") + F.col("at")).alias("start"), "n_tokens", "digest")


@query("op9_token_file")
def op9(t):
    """Write every document's ids as directly addressable codes and read them back."""
    import uuid

    folder = f"{shared_folder(t.spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(t.documents, folder)
    return read_documents(t.spark, folder).withColumnRenamed("digest", "ids_crc32")
