"""Entries that span several lines (gaps and islands), numbered block by block.

A running count over one long document would be one task.  Lines are grouped into
blocks; each block counts its own starts, a table with one row per block carries the
totals forward, and the two are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regweave.functions.labels import CALLSIGN_SHAPES
from regweave.functions.text import repair_controls, strip

# --- fixed values ------------------------------------------------------------------
BLOCK_LINES = 4096
PIECE_LINES = 256
ENTRY_START = r"^([A-Z0-9/]{3,12}), ([A-Z]{1,2}), ?(.*)$"
HEADING = r"^([1-6]) Liste der "
PAGE_NUMBER = r"^Seite \d+$"
LISTS = {1: "Individual", 2: "Training station", 3: "Club station", 4: "Special event station",
         5: "Relay/beacon", 6: "Experimental station"}
LICENSE_CLASSES = ("A", "E", "N")
MAX_REJECTED_FRACTION = 0.005
# -----------------------------------------------------------------------------------


def number_islands(lines: DataFrame, doc: str, line_no: str, is_start: Column, out: str = "island",
                   block_lines: int = BLOCK_LINES) -> DataFrame:
    """Running number of the last start at or before each line (0 before the first)."""
    marked = lines.withColumn("_start", F.when(is_start, 1).otherwise(0)).withColumn(
        "_block", F.floor(F.col(line_no) / block_lines)
    )
    local = Window.partitionBy(doc, "_block").orderBy(line_no).rowsBetween(Window.unboundedPreceding, 0)
    totals = marked.groupBy(doc, "_block").agg(F.sum("_start").alias("_n"))
    before = Window.partitionBy(doc).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(doc, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (
        marked.withColumn("_local", F.sum("_start").over(local))
        .join(base, [doc, "_block"])
        .withColumn(out, (F.col("_base") + F.col("_local")).cast("bigint"))
        .drop("_start", "_block", "_local", "_base")
    )


def previous_value(rows: DataFrame, keys: list[str], position: str, value: str, out: str,
                   block_rows: int = BLOCK_LINES) -> DataFrame:
    """The value of the row before, in ``position`` order within ``keys``.

    Like `number_islands`, long groups are cut into blocks: the lag is taken inside a
    block, and the first row of a block gets the last value of the blocks before it.
    """
    marked = rows.withColumn("_block", F.floor(F.col(position) / block_rows))
    local = Window.partitionBy(*keys, "_block").orderBy(position)
    ends = marked.groupBy(*keys, "_block").agg(F.max_by(value, position).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_block", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    return (
        marked.withColumn("_lag", F.lag(value).over(local))
        .join(carried, [*keys, "_block"])
        .withColumn(out, F.coalesce("_lag", "_carried"))
        .drop("_block", "_lag", "_carried")
    )


def carry_last(rows: DataFrame, keys: list[str], position: str, value: str, out: str, block_rows: int = BLOCK_LINES) -> DataFrame:
    """The last value that was set at or before each row, in ``position`` order within ``keys``; null before the first.

    Each block of rows comes down to one transition, to keep the state or to set it; the transitions are composed
    over a table with one row per block, and the state at its start is handed back to the block.
    """
    marked = rows.withColumn("_block", F.floor(F.col(position) / block_rows))
    local = Window.partitionBy(*keys, "_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    ends = marked.groupBy(*keys, "_block").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(position))).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_block", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    return (
        marked.withColumn("_here", F.last(value, ignorenulls=True).over(local))
        .join(carried, [*keys, "_block"])
        .withColumn(out, F.coalesce("_here", "_carried"))
        .drop("_block", "_here", "_carried")
    )


def _glued(parts: Column) -> Column:
    """Parts joined by a space, but a part that ends in a hyphen is continued."""
    return F.aggregate(
        parts,
        F.lit(""),
        lambda acc, s: F.when((acc == "") | acc.endswith("-"), F.concat(acc, s)).otherwise(
            F.concat(acc, F.lit(" "), s)
        ),
    )


def join_lines(lines: DataFrame, keys: list[str], line_no: str, text: str, piece: int = PIECE_LINES) -> DataFrame:
    """Text of each island: lines in order, joined by a space, except that a line that
    ends in a hyphen continues the word.

    Lines are joined in pieces of bounded length first, so an island of any length is shared by many tasks up to
    its last step, which sees one row a piece.
    """
    def ordered(at: str, of: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct(at, of))), lambda x: x[of])

    pieces = lines.groupBy(*keys, F.floor(F.col(line_no) / piece).alias("_piece")).agg(_glued(ordered(line_no, text)).alias("_text"), F.count(F.lit(1)).alias("_n"))
    return pieces.groupBy(*keys).agg(_glued(ordered("_piece", "_text")).alias("entry_text"), F.sum("_n").alias("n_lines"))


def callbook_entries(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries and violations of a ``(doc, page, line_no, text)`` table of a callsign book.

    Headings 1..6 open a list (their following lines up to a blank line or an entry
    belong to the heading, a block with dot leaders is the table of contents); an entry
    line opens an entry; other lines continue it.  Entries have doc, list_no, callsign,
    license_class, entry_text, rejected.  Violations are entries out of callsign order
    and lines on list pages that belong to nothing.
    """
    text = strip(F.col("text"))
    # ``line_no`` restarts on every page; the page takes the upper half, so a page of any length keeps its order.
    base = lines.select("doc", "page", (F.shiftleft(F.col("page").cast("bigint"), 32) + F.col("line_no")).alias("line_no"),
                        text.alias("text"))
    filled = base.withColumn("_first", F.min(F.when(F.col("text") != "", F.col("line_no"))).over(Window.partitionBy("doc", "page")))
    body = filled.filter(~((F.col("line_no") == F.col("_first")) & F.col("text").rlike(PAGE_NUMBER))).drop("_first")
    heading = F.col("text").rlike(HEADING)
    entry = F.col("text").rlike(ENTRY_START)
    # Segments: a blank line, a heading or an entry starts one.
    breaks = heading | entry | (F.col("text") == "")
    kind = F.when(heading, "H").when(entry, "E").when(F.col("text") == "", "B")
    seg = number_islands(body.withColumn("_kind", kind), "doc", "line_no", breaks, "segment")
    heads = seg.filter("segment > 0").groupBy("doc", "segment").agg(
        F.min_by("_kind", "line_no").alias("kind"), F.min("line_no").alias("line_no"),
        F.min_by("text", "line_no").alias("head"), F.bool_or(F.col("text").contains("..")).alias("leaders"),
    )
    # A heading segment without dot leaders opens a list, once list 1 was reached.
    number = F.regexp_extract("head", HEADING, 1).try_cast("int")
    opened = heads.filter("kind = 'H' and not leaders").select("doc", "line_no", number.alias("_opens"))
    lines_in = seg.join(heads.select("doc", "segment", "kind", "leaders"), ["doc", "segment"], "left")
    # The list of a line is the one that the last opening heading has set.
    listed = carry_last(lines_in.join(opened, ["doc", "line_no"], "left"), ["doc"], "line_no", "_opens", "list_no")
    placed = listed.filter("kind is distinct from 'H' and text <> '' and list_no is not null").drop("_opens")
    numbered = number_islands(placed, "doc", "line_no", F.col("text").rlike(ENTRY_START), "entry_no")
    stray = numbered.filter("entry_no = 0").select("doc", "line_no", "text", F.lit("stray line").alias("problem"))
    rest = F.when(F.col("text").rlike(ENTRY_START), F.regexp_extract("text", ENTRY_START, 3)).otherwise(F.col("text"))
    in_entry = numbered.filter("entry_no > 0").withColumn("text", rest)
    first = numbered.filter(F.col("text").rlike(ENTRY_START)).select(
        "doc", "entry_no", "line_no", "list_no", F.regexp_extract("text", ENTRY_START, 1).alias("callsign"),
        F.regexp_extract("text", ENTRY_START, 2).alias("license_class"),
    )
    joined = join_lines(in_entry, ["doc", "entry_no"], "line_no", "text")
    ok = F.col("callsign").rlike(CALLSIGN_SHAPES["bnetza"]) & F.col("license_class").isin(*LICENSE_CLASSES)
    entries = first.join(joined, ["doc", "entry_no"]).withColumn("rejected", ~ok).withColumn(
        "entry_text", repair_controls(F.col("entry_text"))
    )
    accepted = entries.filter("not rejected").select("doc", "list_no", "entry_no", "line_no", "callsign")
    disorder = previous_value(accepted, ["doc", "list_no"], "entry_no", "callsign", "_prev").filter("callsign < _prev").select(
        "doc", "line_no", F.col("callsign").alias("text"), F.lit("out of order").alias("problem")
    )
    return entries, stray.unionByName(disorder)
