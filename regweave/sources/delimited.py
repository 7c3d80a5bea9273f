"""Delimited files through Spark's CSV reader, each file with a layout of its own.

One job profiles all files of a path: their first line, whether they are UTF-8, and how their quotes pair up.
Quoted line breaks can only occur where a line has an odd number of quotes; files without such lines are split over
tasks, the others are read whole, one task each.
"""

from __future__ import annotations

import csv
import logging
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave.functions.text import blank_to_null, byte_translate
from regweave.operators.guards import GateError
from regweave.sources.base import file_order

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Profile:
    """First line of a file (bytes as ISO-8859-1 text), and what its lines tell."""

    first: str
    utf8: bool
    odd_lines: int
    quotes: int

    @property
    def unbalanced(self) -> bool:
        """An odd number of quotes: one of them is never closed, or stands for itself."""
        return self.quotes % 2 == 1


def profile(spark: SparkSession, path: str | list[str], title: str | None = None) -> dict[str, Profile]:
    """Profiles of the files that have a line; lines that start with ``title`` are not first lines."""
    raw = spark.read.text(path).select("value", file_order())
    text = F.regexp_replace(F.decode(F.col("value").cast("binary"), "ISO-8859-1"), "\r$", "")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = raw.select(text.alias("line"), F.is_valid_utf8("value").alias("utf8"), quotes.alias("quotes"), F.col("_ord.path").alias("path"), "_ord")
    is_first = F.col("line").rlike(r"[^\x00-\x20]") & (F.lit(True) if title is None else ~F.ltrim("line").startswith(title))
    rows = lines.groupBy("path").agg(
        F.min_by("line", F.when(is_first, F.col("_ord"))).alias("first"), F.bool_and("utf8").alias("utf8"),
        F.count_if(F.col("quotes") % 2 == 1).alias("odd"), F.sum("quotes").alias("quotes"))
    return {r["path"]: Profile(r["first"], r["utf8"], r["odd"], r["quotes"]) for r in rows.collect() if r["first"] is not None}


def header_cells(found: Profile, sep: str, encoding: str = "UTF-8") -> list[str]:
    """Cells of a first line."""
    text = found.first.encode("latin-1").decode("utf-8", "replace") if encoding == "UTF-8" and found.utf8 else found.first
    return next(csv.reader([text.removeprefix("﻿")], delimiter=sep), [])


def table(spark: SparkSession, path: str, columns: dict[str, int | None], sep: str = ",", encoding: str = "UTF-8", fallback: str | None = None,
          header_tokens: set[str] | None = None, required: list[str] | None = None, title: str | None = None,
          key: Callable[[str], str] = str.upper) -> DataFrame:
    """Named columns of delimited files, trimmed, blank to null, and ``_ord``.

    Quotes as in RFC 4180: a quoted cell may hold separators, doubled quotes and line breaks.  ``columns`` gives the
    position of a column that no header names (``None``: it is null then).  Every file starts with a header, whose
    ``required`` names must be there; with ``header_tokens`` only files whose first cell is one of them do.  ``title``:
    start of a line that may stand above the header.  ``key``: how names are compared.  ``fallback``: code page of files that are not UTF-8.
    Files whose quotes do not pair up are read as they are and named in the log.
    """
    files = profile(spark, path, title)
    if not files and required:
        raise GateError(f"{path}: missing column(s) {', '.join(required)}")
    layouts: dict[str, tuple[int | None, ...]] = {}
    headed, widths = set(), {True: 1, False: 1}
    for name, found in files.items():
        if found.unbalanced:
            log.warning("%s: unbalanced quotes", name)
        head = header_cells(found, sep, encoding)
        position = dict(columns)
        if header_tokens is None or (head and head[0].strip().lower() in header_tokens):
            headed.add(name)
            at = {key(h.strip()): i for i, h in reversed(list(enumerate(head)))}
            if missing := [c for c in required or [] if key(c) not in at]:
                raise GateError(f"{name}: missing column(s) {', '.join(missing)}")
            position = {c: at.get(key(c), d) for c, d in columns.items()}
        layouts[name] = tuple(position.values())
        widths[name in headed] = max([widths[name in headed], len(head), *(p + 1 for p in position.values() if p is not None)])
    plain = [name for name, found in files.items() if fallback is not None and not found.utf8]
    out = None
    # Files are read together as far as header, line breaks, code page and title agree: up to eight scans.
    groups: dict[tuple[bool, bool, bool], list[str]] = {}
    for name, found in files.items():
        groups.setdefault((name in headed, found.odd_lines > 0, name in plain), []).append(name)
    for (is_headed, broken_lines, is_plain), names in sorted(groups.items()):
        # Paths of the metadata column are encoded.
        source = path if len(groups) == 1 else [unquote(n) for n in names]
        cells = [f"c{i}" for i in range(widths[is_headed])]
        reader = spark.read.schema(", ".join(f"{c} string" for c in cells)).options(
            sep=sep, quote='"', escape='"', multiLine=broken_lines, header=is_headed, mode="PERMISSIVE", encoding="ISO-8859-1" if is_plain else encoding)
        rows = reader.csv(source).select(*cells, file_order())
        own = {layouts[n] for n in names}
        if title is not None:
            # The title was taken for the header; the header itself is the first row under it.
            first = {tuple(header_cells(files[n], sep, encoding)) for n in names if files[n].first}
            for head in first:
                rows = rows.filter(~F.array(*cells).eqNullSafe(F.array(*[F.lit(h or None).cast("string") for h in (*head, *[""] * (len(cells) - len(head)))])))
        if len(own) == 1:
            picked = [F.col(cells[p]) if p is not None else F.lit(None).cast("string") for p in next(iter(own))]
        else:
            # One small row a file; joined, so that the plan does not grow with the files.
            held = spark.createDataFrame([(n, [p + 1 if p is not None else 0 for p in layouts[n]]) for n in names], "path string, at array<int>")
            rows = rows.join(held, F.col("_ord.path") == held["path"])
            every = F.array(*cells)
            picked = [F.when(F.col("at")[j] > 0, F.try_element_at(every, F.greatest(F.col("at")[j], F.lit(1)))) for j in range(len(columns))]
        named = [_clean(c, fallback if is_plain else None).alias(n) for c, n in zip(picked, columns)]
        part = rows.select(*named, "_ord")
        out = part if out is None else out.unionByName(part)
    if out is None:
        empty = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
        return empty.withColumn("_ord", F.lit(None).cast("struct<path:string,block:bigint,row:bigint>"))
    return out


def _clean(value: Column, page: str | None) -> Column:
    text = byte_translate(value, page) if page else F.regexp_replace(value, "^﻿", "")
    return blank_to_null(text)
