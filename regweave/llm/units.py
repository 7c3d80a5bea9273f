"""Substring dedup by paragraph hashing: repeated units go, the earliest ranked occurrence stays.

A unit is a run of words that ends where its content says so (a line break, or a word of every third by its
checksum, once the run has seven words), so a repeated passage falls into the same units wherever it stands.
Every line that is not blank is a unit too, whatever its length and whatever stands before it.
Units are normalised (case, white space), hashed to 128 bits and grouped over the whole corpus.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.llm.batches import batch_of, slices
from regweave.llm.catalog import query

#: Fewest words of a unit, and one word in so many ends it.
WORDS, EVERY = 7, 3
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def units(text: str, words: int = WORDS, every: int = EVERY) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of the units of a text in characters; runs of fewer words are no units."""
    out, start, end, run = [], 0, 0, []
    for m in _WORD.finditer(text):
        word = m.group().lower().encode()
        if run and "\n" in text[end : m.start()]:
            if len(run) >= words:
                out.append((start, end, xxhash.xxh3_128_digest(b" ".join(run))))
                run = []
        if not run:
            start = m.start()
        run.append(word)
        end = m.end()
        if len(run) >= words and zlib.crc32(word) % every == 0:
            out.append((start, end, xxhash.xxh3_128_digest(b" ".join(run))))
            run = []
    if len(run) >= words:
        out.append((start, end, xxhash.xxh3_128_digest(b" ".join(run))))
    return out


def line_units(text: str) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of the lines of a text that are not blank, in characters and without the white space around them."""
    out, at = [], 0
    for line in text.split("\n"):
        found = list(_WORD.finditer(line))
        if found:
            joined = b" ".join(m.group().lower().encode() for m in found)
            out.append((at + found[0].start(), at + found[-1].end(), xxhash.xxh3_128_digest(joined)))
        at += len(line) + 1
    return out


def repeated_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, every: int = EVERY) -> DataFrame:
    """Repeated lines and repeated content-defined units, as in ``repeated_units``; the spans of the two may overlap.

    Each occurrence points at an earlier one, so of every passage that is removed a copy stays.  A span that is
    both a line and a unit is one row if both have the same first occurrence.
    """
    lines = _repeated(docs, id, text, line_units)
    return lines.unionByName(repeated_units(docs, id, text, words, every)).distinct()


def repeated_units(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, every: int = EVERY) -> DataFrame:
    """One row per unit to remove: ``id``, ``start``, ``end`` (characters of the original text), ``kept_id``, ``kept_start``.

    The rank of an occurrence is (id, start), null ids first.  Null and empty texts have no units; rows that
    repeat an id with its text are one document, whose units do not remove each other's first occurrence; an
    empty table gives an empty table; other columns are not read.
    """
    return _repeated(docs, id, text, lambda t: units(t, words, every))


def _repeated(docs: DataFrame, id: str, text: str, units_of: Callable[[str], list[tuple[int, int, bytes]]]) -> DataFrame:
    docs = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    id_type = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "_text"):
            schema = pa.schema([("_id", part.schema.field("_id").type), ("start", pa.int32()), ("end", pa.int32()), ("digest", pa.binary())])
            found = [units_of(t.decode()) for t in texts]
            owner = pa.array([i for i, u in enumerate(found) for _ in u], pa.int32())
            flat = [u for us in found for u in us]
            if flat:
                starts, ends, digests = zip(*flat)
                yield batch_of(schema, part.column("_id").take(owner), starts, ends, digests)

    all_units = docs.mapInArrow(run, f"_id {id_type}, start int, end int, digest binary")
    rank = F.struct("_id", "start")
    first = all_units.groupBy("digest").agg(F.min(rank).alias("kept"), F.max(rank).alias("last")).filter("not (kept <=> last)").drop("last")
    # The first of each digest is combined before the shuffle; the join has one row per digest on that side.
    out = all_units.join(first, "digest").filter(~rank.eqNullSafe(F.col("kept")))
    return out.select(F.col("_id").alias(id), "start", "end", F.col("kept._id").alias("kept_id"), F.col("kept.start").alias("kept_start")).distinct()


@query("op8_unit_dedup")
def op8(t):
    """Every line and unit of every document that an earlier one holds."""
    out = repeated_spans(t.documents)
    return out.select("doc_id", F.col("start").alias("span_start"), F.col("end").alias("span_end"), F.col("kept_id").alias("kept_doc_id"), "kept_start")
