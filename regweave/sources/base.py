"""Shared scan pieces: row order, decoding, headers, provenance and the adapter table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave.functions.text import byte_translate, fold_text
from regweave.operators.guards import GateError
from regweave.schemas import RECORD

ORDER_TYPE = "struct<path:string,block:bigint,row:bigint>"


def file_order() -> Column:
    """Position of a row in its files: path, split start, row in the split.

    Split numbers do not follow file order, but rows inside one split do.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").cast("bigint").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias("_ord")


def table_order(column: str) -> Column:
    """The same struct for rows that come from a table with a natural key."""
    return F.struct(
        F.lit("").alias("path"), F.lit(0).cast("bigint").alias("block"), F.col(column).cast("bigint").alias("row")
    ).alias("_ord")


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8", line_sep: str | None = None) -> DataFrame:
    """Text lines with their order; blank lines are skipped."""
    if encoding.upper() == "UTF-8":
        reader = spark.read
        if line_sep:
            reader = reader.option("lineSep", line_sep)
        lines = reader.text(path)
        return lines.select(F.regexp_replace("value", "\r$", "").alias("value"), file_order()).filter("value <> ''")
    # The bytes of the line as they are, so that no character of it separates cells.
    lines = spark.read.text(path).select(F.decode(F.col("value").cast("binary"), encoding).alias("value"), file_order())
    return lines.filter(F.col("value").rlike(r"[^\x00-\x20]"))


def read_lines_guessing(spark: SparkSession, path: str, fallback: str) -> DataFrame:
    """Lines of files that are UTF-8 if every line decodes as such, else ``fallback``.

    The bytes are kept as ISO-8859-1 text; one pass aggregates a flag per file.
    """
    raw = read_lines(spark, path, "ISO-8859-1")
    back = F.encode("value", "ISO-8859-1")
    flags = raw.groupBy(F.col("_ord.path").alias("p")).agg(
        F.bool_and(F.is_valid_utf8(back.cast("string"))).alias("utf8")
    )
    plain = [r["p"] for r in flags.filter("not utf8").collect()]  # one row per file
    is_plain = F.col("_ord.path").isin(*plain) if plain else F.lit(False)
    text = F.when(is_plain, byte_translate(F.col("value"), fallback)).otherwise(back.cast("string"))
    return raw.select(F.regexp_replace(text, "^\ufeff", "").alias("value"), "_ord")


def json_items(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects of JSON arrays or of JSON lines, with ``_ord`` and ``file`` (name of their file).

    Files with one whole object a line, as arrays are usually written, are split over tasks; others are read by one
    task each.  A file that is no JSON fails the job.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), file_order())
    body = F.regexp_replace(F.btrim(F.regexp_replace("value", "^\ufeff", ""), F.lit(" \t\r[,")), r"[,\]\s]+$", "")
    braces = [F.length(body) - F.length(F.replace(body, F.lit(b), F.lit(""))) for b in "{}"]
    # Two objects on a line, or what looks like it inside one, make the file one to be read as a whole.
    whole = (body == "") | (body.startswith("{") & body.endswith("}") & (braces[0] == braces[1]) & ~body.rlike(r"\}\s*,?\s*\{"))
    files = lines.groupBy(F.col("_ord.path").alias("path")).agg(F.bool_and(whole).alias("by_line"), F.sum(F.length(body)).alias("n")).collect()
    parts, order = [], [f.alias(n) for f, n in ((F.col("_metadata.file_name"), "file"),)]
    by_line = [unquote(r["path"]) for r in files if r["by_line"] and r["n"]]
    others = [unquote(r["path"]) for r in files if not r["by_line"]]
    if by_line:
        own = spark.read.text(by_line if others else path).select("value", *order, file_order()).filter(body != "")
        parts.append(own.select(F.from_json(body, schema, {"mode": "FAILFAST"}).alias("r"), "file", "_ord").select("r.*", "file", "_ord"))
    if others:
        read = spark.read.schema(schema).options(multiLine=True, mode="FAILFAST").json(others if by_line else path)
        parts.append(read.select("*", *order, file_order()))
    if not parts:
        return spark.createDataFrame([], schema).withColumns({"file": F.lit(""), "_ord": F.lit(None).cast(ORDER_TYPE)})
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def split_delimited(lines: DataFrame, sep: str) -> DataFrame:
    """Lines without quoting to ``cells`` arrays."""
    return lines.select(F.split("value", "[" + sep + "]" if sep in "|;" else sep, -1).alias("cells"), "_ord")


def cell(index: int) -> Column:
    """Zero-based cell, trimmed, blank or absent to null."""
    from regweave.functions.text import blank_to_null

    return blank_to_null(F.try_element_at("cells", F.lit(index + 1)))


def first_cells(rows: DataFrame) -> dict[str, list[str]]:
    """First row of every file of an already split row table (one row per file)."""
    firsts = rows.groupBy(F.col("_ord.path").alias("p")).agg(F.min_by("cells", "_ord").alias("cells"))
    return {r["p"]: [c or "" for c in r["cells"]] for r in firsts.collect()}


def by_header(
    rows: DataFrame,
    columns: dict[str, int | None],
    header_tokens: set[str] | None = None,
    required: list[str] | None = None,
) -> DataFrame:
    """Cells to named columns.

    With ``header_tokens`` the header row is optional: a first row whose first cell is
    one of them re-points the columns it names, the rest keep their default position.
    Without it every file starts with a header, and ``required`` names must be in it.
    Each file may have its own layout; files with one layout share one projection.
    """
    layouts: dict[tuple, list[str]] = {}
    path = F.col("_ord.path")
    is_head = F.lit(False)
    for name, head in first_cells(rows).items():
        found = {h.lstrip("\ufeff").strip().upper(): i for i, h in enumerate(head)}
        position = dict(columns)
        if header_tokens is None or head[0].strip().lower() in header_tokens:
            missing = [c for c in required or [] if c.upper() not in found]
            if missing:
                raise GateError(f"{name}: missing column(s) {', '.join(missing)}")
            position = {c: found.get(c.upper(), d) for c, d in columns.items()}
            is_head = is_head | ((path == name) & (F.col("cells") == F.array(*[F.lit(h) for h in head])))
        layouts.setdefault(tuple(position.items()), []).append(name)
    out = []
    for column in columns:
        value = F.lit(None).cast("string")
        for layout, paths in layouts.items():
            index = dict(layout)[column]
            here = cell(index) if index is not None else F.lit(None).cast("string")
            value = here if len(layouts) == 1 else F.when(path.isin(*paths), here).otherwise(value)
        out.append(value.alias(column))
    return rows.filter(~is_head).select(*out, "_ord")


def folded_positions(header: list[str], wanted: dict[str, str]) -> dict[str, int]:
    """Field to position for header cells matched after accent and case folding."""
    found = {}
    for i, name in enumerate(header):
        key = fold_text(name)
        if key in wanted:
            found.setdefault(wanted[key], i)
    missing = set(wanted.values()) - set(found)
    if missing:
        raise GateError(f"table lacks column(s) {sorted(missing)}; header: {header}")
    return found


def file_date() -> Column:
    """Provenance date of a row: the UTC modification day of its file."""
    return F.date_format("_metadata.file_modification_time", "yyyy-MM-dd")


def records(rows: DataFrame, source: str, synced_at: str | None, /, **values: Column) -> DataFrame:
    """Project to the record schema plus ``_ord``."""
    from regweave.schemas import _DEFAULTS

    out = []
    for field in RECORD.fields:
        if field.name in values:
            value = values[field.name]
        elif field.name == "source":
            value = F.lit(source)
        elif field.name == "synced_at":
            value = F.lit(synced_at)
        elif field.name in _DEFAULTS:
            value = F.expr(_DEFAULTS[field.name])
        else:
            value = F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    order = F.col("_ord").cast(ORDER_TYPE) if "_ord" in rows.columns else F.lit(None).cast(ORDER_TYPE)
    return rows.select(*out, order.alias("_ord"))


@dataclass(frozen=True)
class Register:
    """A register adapter: ``read(spark, path, synced_at)`` gives records with ``_ord``."""

    tag: str
    read: Callable[[SparkSession, str, str | None], DataFrame]

