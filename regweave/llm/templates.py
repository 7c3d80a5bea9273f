"""Line dedup by a log-template tree, with DataFrame operations only.

Lines are parsed into a tree of fixed depth: token count, then the first tokens, tokens with digits being
variable fields.  Below a leaf a position is constant when one token holds it in more than half of the leaf's
lines, and variable otherwise; the constant positions are the leaf's template.  Templates, and single masked
lines, that recur in many different texts are boilerplate: their lines are dropped everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.llm.catalog import query
from regweave.session import stored

#: Leading tokens of the tree, fewest tokens of a line that is looked at, different texts of a recurring template.
DEPTH, TOKENS, TEXTS = 4, 5, 10
#: Fewest constant positions of a template, in per cent of its tokens.
CONSTANT_PERCENT = 60

_SPACE = r"[\x09-\x0D\x20]+"
_FIELD = r"[^\x09-\x0D\x20]*[0-9][^\x09-\x0D\x20]*"
_EDGES = r"^[\x09-\x0D\x20]+|[\x09-\x0D\x20]+$"
# The same matches without going back: only where a token starts, up to its first digit.
_FIELD_AT_START = r"(?<![^\x09-\x0D\x20])[^\x09-\x0D\x200-9]*[0-9][^\x09-\x0D\x20]*"


def _masked(line: Column) -> Column:
    """A line with single spaces between tokens; tokens with digits become one variable field."""
    odd = r"[\x09\x0B-\x0D]|\x20\x20"
    line = F.when(line.rlike("[0-9]"), F.regexp_replace(line, _FIELD_AT_START, "<*>")).otherwise(line)
    line = F.when(line.rlike(odd), F.regexp_replace(line, r"[\x09\x0B-\x0D\x20]+", " ")).otherwise(line)
    return F.trim(line)


def masked_lines(text: Column) -> Column:
    """Lines of a text, each masked on its own: most lines have no digit and are only looked at."""
    return F.transform(F.split(text, "\n"), _masked)


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.length(text).alias("k2")]


def _lines(docs: DataFrame, text: str, least: int, depth: int) -> DataFrame:
    """``k1 k2`` (the text), ``no``, ``s`` (masked line), ``size``, ``leaf``, ``line`` of every line with enough tokens."""
    # The key is made below the generator, once a text and not once a line; the lines inside it, so no later
    # expression makes them again.
    rows = docs.filter(F.col(text).isNotNull()).select(*_key(F.col(text)), F.col(text).alias("text"))
    rows = rows.select("k1", "k2", F.posexplode(masked_lines(F.col("text"))).alias("no", "s"))
    size = F.length("s") - F.length(F.replace("s", F.lit(" "))) + 1
    rows = rows.withColumn("size", size).filter(F.col("size") >= least)
    leaf = F.xxhash64("size", F.substring_index("s", " ", depth))
    return rows.withColumn("leaf", leaf).withColumn("line", F.xxhash64("s"))


def recurring(docs: DataFrame, text: str = "text", depth: int = DEPTH, tokens: int = TOKENS, texts: int = TEXTS,
              constant_percent: int = CONSTANT_PERCENT) -> DataFrame:
    """``k1 k2`` (hash and length of a text) and ``drop``, the numbers of its lines that recurring templates cover."""
    parsed = stored(_lines(docs, text, tokens, depth))
    narrow = parsed.select("k1", "k2", "no", "leaf", "line")
    # Texts of each masked line, counted in two steps so that a line of a third of all texts is split.
    lines = narrow.select("leaf", "line", "k1", "k2").distinct().groupBy("leaf", "line").agg(F.count("*").alias("n"))
    lines = stored(lines)
    whole = lines.filter(F.col("n") >= texts).select("leaf", "line")
    leaves = lines.groupBy("leaf").agg(F.sum("n").alias("total"), F.count("*").alias("_lines")).filter((F.col("total") >= texts) & (F.col("_lines") > 1))
    varied = lines.join(leaves.select("leaf", "total"), "leaf")
    words = parsed.select("leaf", "line", "s", "size").join(varied, ["leaf", "line"]).groupBy("leaf", "line").agg(*[F.first(c).alias(c) for c in ("s", "size", "n", "total")])
    at = stored(words.select("leaf", "line", "n", "total", "size", F.posexplode(F.slice(F.split("s", " "), F.lit(depth + 1), F.col("size"))).alias("pos", "token")))
    constant = at.groupBy("leaf", "pos", "token", "total", "size").agg(F.sum("n").alias("_n")).filter(2 * F.col("_n") > F.col("total"))
    templates = constant.groupBy("leaf", "size").agg(F.count("*").alias("fixed")).filter(100 * (F.col("fixed") + depth) >= constant_percent * F.col("size"))
    fits = at.join(constant.select("leaf", "pos", "token"), ["leaf", "pos", "token"]).groupBy("leaf", "line").agg(F.count("*").alias("fixed"))
    fits = fits.join(templates.select("leaf", "fixed"), ["leaf", "fixed"]).select("leaf", "line")
    counted = narrow.join(fits, ["leaf", "line"]).select("leaf", "k1", "k2").distinct().groupBy("leaf").agg(F.count("*").alias("n"))
    general = fits.join(counted.filter(F.col("n") >= texts).select("leaf"), "leaf")
    dropped = whole.unionByName(general).distinct()
    # One text's lines at most in a list.
    return narrow.join(dropped, ["leaf", "line"]).groupBy("k1", "k2").agg(F.sort_array(F.collect_set("no")).alias("drop"))


def drop_recurring(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of ``text``; ``n_lines`` and ``n_dropped`` are added.

    Copies of a text count once, so a copied document does not make its lines recur.  Null texts stay null with
    no lines; an empty text has one line and keeps it; all rows and other columns stay, columns named as the two
    counts are replaced; ties do not occur; an empty table gives an empty table.
    """
    docs = docs.drop("n_lines", "n_dropped")
    keyed = docs.select("*", F.xxhash64(text).alias("_k1"), F.length(text).alias("_k2"))
    found = recurring(docs, text, **how).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("drop").alias("_drop"))
    rows = keyed.join(found, ["_k1", "_k2"], "left")
    lines = F.split(F.col(text), "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("_drop", i)), "\n")
    rows = rows.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("bigint"))
    rows = rows.withColumn("n_dropped", F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("bigint"))
    rows = rows.withColumn(text, F.when(F.col("_drop").isNull(), F.col(text)).otherwise(kept))
    return rows.select(*docs.columns, "n_lines", "n_dropped")


def kept_lines_sql(source: str, texts: int = TEXTS) -> str:
    """CTEs ``dropped_lines(text, no)`` of a table ``source`` with a ``text`` column, in DuckDB SQL."""
    ws, field, edges = r"[\x09-\x0D\x20]+", _FIELD, _EDGES
    return rf"""
lt AS (SELECT DISTINCT text FROM {source} WHERE text IS NOT NULL),
ll AS (SELECT text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no FROM lt),
lm AS (SELECT text, no, string_split_regex(regexp_replace(regexp_replace(line, '{field}', '<*>', 'g'), '{edges}', '', 'g'), '{ws}') AS m FROM ll),
lp AS (SELECT text, no, m, len(m) || ' ' || array_to_string(m[1:{DEPTH}], ' ') AS leaf, array_to_string(m, ' ') AS masked
       FROM lm WHERE len(m) >= {TOKENS}),
lc AS (SELECT leaf, masked, any_value(m) AS m, count(DISTINCT text) AS n FROM lp GROUP BY ALL),
lv AS (SELECT leaf, sum(n) AS total FROM lc GROUP BY leaf HAVING sum(n) >= {texts} AND count(*) > 1),
la AS (SELECT leaf, masked, n, total, len(m) AS size, generate_subscripts(m[{DEPTH + 1}:], 1) AS pos, unnest(m[{DEPTH + 1}:]) AS token
       FROM lc JOIN lv USING (leaf)),
lk AS (SELECT leaf, pos, token, size FROM la GROUP BY leaf, pos, token, total, size HAVING 2 * sum(n) > total),
lx AS (SELECT leaf, count(*) AS fixed FROM lk GROUP BY leaf, size HAVING 100 * (count(*) + {DEPTH}) >= {CONSTANT_PERCENT} * size),
lf AS (SELECT leaf, masked FROM (SELECT la.leaf, la.masked, count(*) AS fixed FROM la JOIN lk USING (leaf, pos, token) GROUP BY ALL)
       JOIN lx USING (leaf, fixed)),
lg AS (SELECT leaf FROM lp JOIN lf USING (leaf, masked) GROUP BY leaf HAVING count(DISTINCT text) >= {texts}),
ld AS (SELECT leaf, masked FROM lc WHERE n >= {texts} UNION SELECT leaf, masked FROM lf JOIN lg USING (leaf)),
dropped_lines AS (SELECT DISTINCT text, no FROM lp JOIN ld USING (leaf, masked))"""


ORACLE = f"""
WITH {kept_lines_sql("documents")},
k AS (SELECT text, count(*) AS n FROM dropped_lines GROUP BY text),
r AS (SELECT ll.text, array_to_string(list(line ORDER BY ll.no), chr(10)) AS kept FROM ll ANTI JOIN dropped_lines d ON ll.text = d.text AND ll.no = d.no
      GROUP BY ll.text)
SELECT doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines, coalesce(k.n, 0)::BIGINT AS n_dropped,
       md5(CASE WHEN d.text IS NOT NULL THEN coalesce(r.kept, '') END) AS kept_md5
FROM documents d LEFT JOIN k ON d.text = k.text LEFT JOIN r ON d.text = r.text"""


@query("op7_line_templates", ORACLE)
def op7(t):
    """Lines and dropped lines of every document and a digest of what is kept."""
    out = drop_recurring(t.documents.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.md5(F.encode("text", "UTF-8")).alias("kept_md5"))
