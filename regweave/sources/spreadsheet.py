"""Spreadsheet XML through Spark's XML reader: rows of sparse cells, each file with a header of its own.

One job looks at all lines first.  Document type declarations are refused.  Files with at most one whole row a line are
split over tasks; others are read by one task each, which streams their rows.  Of several worksheets only the first
counts; such a file is read sheet by sheet.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave.functions.text import blank_to_null, strip
from regweave.operators.guards import GateError
from regweave.sources.base import file_order

_ROW = "Cell array<struct<_Index: int, Data: string>>"
# Tags that formatted text inside a cell may have.
_FORMAT = r"(?i)</?(?:\w+:)?(?:b|i|u|s|sub|sup|font|span|p|br)\b[^<>]*>"


def place_by_index(cells: Column) -> Column:
    """Sparse cells (``data``, optional 1-based ``index``) to a dense array."""
    empty = F.array().cast("array<string>")

    def put(acc: Column, item: Column) -> Column:
        gap = F.greatest(F.coalesce(item["index"] - 1 - F.size(acc), F.lit(0)), F.lit(0))
        return F.concat(acc, F.array_repeat(F.lit(""), gap), F.array(F.coalesce(item["data"], F.lit(""))))

    return F.aggregate(cells, empty, put)


def _dense(cell: Column) -> Column:
    data = F.transform(cell, lambda c: F.struct(c["_Index"].alias("index"), strip(F.regexp_replace(c["Data"], _FORMAT, "")).alias("data")))
    return place_by_index(F.coalesce(data, F.array().cast("array<struct<index:int,data:string>>")))


def spreadsheet_rows(spark: SparkSession, path: str) -> DataFrame:
    """``cells`` of every row of the first worksheet of every file, and ``_ord``; an empty row has no cells."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"))
    opened = F.regexp_count("value", F.lit(r"<(?:\w+:)?Row\b"))
    whole = F.col("value").rlike(r"^\s*<(?:\w+:)?Row\b(?:[^>]*/>|.*</(?:\w+:)?Row>)\s*$")
    files = lines.groupBy("path").agg(
        F.bool_or(F.col("value").rlike("<!DOCTYPE|<!ENTITY")).alias("declared"), F.sum(F.regexp_count("value", F.lit(r"<(?:\w+:)?Worksheet\b"))).alias("sheets"),
        F.sum(opened).alias("rows"), F.bool_and((opened == 0) | ((opened == 1) & whole)).alias("by_line")).collect()
    if bad := [r["path"] for r in files if r["declared"]]:
        raise GateError(f"{', '.join(bad)}: document type declarations are refused")
    if not files or any(not r["sheets"] for r in files):
        raise GateError(f"{path}: a file without a worksheet")
    if empty := [r["path"] for r in files if not r["rows"]]:
        raise GateError(f"{', '.join(empty)}: empty worksheet")
    xml = spark.read.format("xml").options(ignoreNamespace=True, mode="PERMISSIVE", columnNameOfCorruptRecord="bad")
    parts = []
    for kind, tag, schema in (("line", "Row", _ROW), ("rows", "Row", _ROW), ("sheets", "Worksheet", f"Table struct<Row: array<struct<{_ROW.replace(' ', ': ', 1)}>>>")):
        names = [unquote(r["path"]) for r in files if kind == ("sheets" if r["sheets"] > 1 else "line" if r["by_line"] else "rows")]
        if not names:
            continue
        # A path of its own for every file: the reader takes a comma-joined list as one path.
        read = xml.option("rowTag", tag).option("multiLine", kind != "line").schema(f"{schema}, bad string")
        rows = read.load(names if len(names) < len(files) else path)
        # Lines outside of rows are no rows; a row that cannot be parsed fails the job.
        rows = rows.select("*", file_order()).filter(F.col("bad").isNull() | F.col("bad").rlike(rf"<(?:\w+:)?{tag}\b"))
        checked = F.when(F.col("bad").isNotNull(), F.raise_error(F.concat(F.col("_ord.path"), F.lit(": not well-formed: "), F.substring("bad", 1, 60))))
        if kind == "sheets":
            # Spark refuses a scan of the corrupt-record column alone.
            first = rows.groupBy("_ord.path").agg(F.min("_ord").alias("_first"), F.count("Table").alias("_n"))
            rows = rows.join(first, (F.col("_ord") == F.col("_first")) & (F.col("_n") >= 0)).select(checked.cast(rows.schema["Table"].dataType).alias("none"), "Table", "_ord")
            rows = rows.select(F.posexplode(F.coalesce("none", "Table")["Row"]).alias("at", "row"), "_ord")
            rows = rows.select(F.col("row.Cell").alias("Cell"), F.struct("_ord.path", "_ord.block", F.col("at").cast("bigint").alias("row")).alias("_ord"))
        else:
            rows = rows.select(F.coalesce(checked.cast(rows.schema["Cell"].dataType), F.col("Cell")).alias("Cell"), "_ord")
        parts.append(rows.select(_dense(F.col("Cell")).alias("cells"), "_ord"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def by_titles(rows: DataFrame, titles: dict[str, str]) -> DataFrame:
    """Columns found by a text that their title holds, in the first row of each file; blank to null."""
    heads = rows.groupBy(F.col("_ord.path").alias("path")).agg(F.min_by(F.struct("cells", "_ord"), "_ord").alias("head")).collect()
    if not heads:
        raise GateError("empty worksheet")
    layouts, firsts = {}, []
    for r in heads:
        header = [c.casefold() for c in r["head"]["cells"]]
        hits = {name: [i for i, h in enumerate(header) if title in h] for name, title in titles.items()}
        if lost := [titles[n] for n, found in hits.items() if not found]:
            raise GateError(f"{r['path']}: no {', '.join(map(repr, lost))} column in {header}")
        layouts[r["path"]] = [found[0] + 1 for found in hits.values()]
        firsts.append((r["path"], r["head"]["_ord"]["block"], r["head"]["_ord"]["row"], layouts[r["path"]]))
    # One small row a file; joined, so that the plan does not grow with the files.
    held = rows.sparkSession.createDataFrame(firsts, "path string, block bigint, row bigint, at array<int>")
    body = rows.join(held, F.col("_ord.path") == held["path"]).filter(F.struct("_ord.block", "_ord.row") > F.struct("block", "row"))
    return body.select(*[blank_to_null(F.try_element_at("cells", F.col("at")[i])).alias(n) for i, n in enumerate(titles)], "_ord")
