"""Column-function queries: case, dates, labels, privacy rules and text scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.functions.address import (
    PLOT_WORDS, STREET_SUFFIXES, STREET_TYPES, STREET_WORDS, UNIT_WORDS, echoes_street, location_has_street_address,
    looks_like_street_address,
)
from regweave.functions.dates import (
    dotted_date, german_edition_date, iso_date, slash_date, slash_date_or_same, spanish_month_date, us_date_or_same,
)
from regweave.functions.labels import (
    CALLSIGN_SHAPES, ORGANISATION_WORDS, RECIPROCAL_SHAPE, bare_host, code_label, first_subdivision, flag_labels,
    is_natural_person, module_letters,
)
from regweave.functions.numbers import to_double, to_whole
from regweave.functions.similarity import name_ratio
from regweave.functions.text import (
    EMAIL_PATTERN, EMAIL_PLACEHOLDER, boundary_name, count_emails, decode_numeric_entities, redact_emails, split_eastern_name,
    split_western_name, title_case, town_only,
)
from regweave.operators.assemble import join_lines, number_islands
from regweave.plans.catalog import Tables, query
from regweave.plans.inputs import call_of, scratch
from regweave.sources.delimited import table
from regweave.sources.directory import network_records, server_records, talkgroup_rows
from regweave.sources.reference import entity_keys, node_drop_counts, node_report
from regweave.sources.registers import ca_records, html_rows


def _cap(word: str) -> str:
    return f"upper(({word})[1]) || lower(({word})[2:])"


@query("title_case", f"""
SELECT p_partkey, CASE p_partkey % 6
  WHEN 0 THEN {_cap('a')} || ' ' || {_cap('b')} WHEN 1 THEN 'Mc' || {_cap('a')} || ' ' || {_cap('b')}
  WHEN 2 THEN {_cap('a')} || ' von ' || {_cap('b')} WHEN 3 THEN {_cap('a')} || '-' || {_cap('b')} || ' III'
  WHEN 4 THEN a || ' ' || b ELSE 'De O''' || {_cap('a')} || ' ARC J.' END AS cased
FROM (SELECT p_partkey, string_split(p_name, ' ')[1] AS a, string_split(p_name, ' ')[2] AS b FROM part)""")
def title_case_query(t: Tables) -> DataFrame:
    """Proper case of shouted names."""
    a, b = F.upper(F.split_part("p_name", F.lit(" "), F.lit(1))), F.upper(F.split_part("p_name", F.lit(" "), F.lit(2)))
    k = F.col("p_partkey") % 6
    raw = (
        F.when(k == 0, F.concat(a, F.lit("  "), b)).when(k == 1, F.concat(F.lit("MC"), a, F.lit(" "), b))
        .when(k == 2, F.concat(a, F.lit(" VON "), b)).when(k == 3, F.concat(a, F.lit("-"), b, F.lit(" III")))
        .when(k == 4, F.col("p_name")).otherwise(F.concat(F.lit("DE O'"), a, F.lit(" ARC J.")))
    )
    return t.part.select("p_partkey", title_case(raw).alias("cased"))


@query("date_normalise", """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN '31-12' ELSE d END AS us_date,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE d END AS slash_date, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE d END AS dotted_date,
       CASE WHEN o_orderkey % 3 = 0 THEN 'soon' ELSE d END AS lenient_date, d AS spanish_date, d AS german_date,
       CASE WHEN o_orderkey % 2 = 0 THEN d END AS strict_date
FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)""")
def date_normalise(t: Tables) -> DataFrame:
    """Seven date layouts, with values that must not parse."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    month = F.month(d)
    es = F.array(*[F.lit(m) for m in ("Ene.", "Feb", "Mar.", "Abr.", "May", "Jun.", "Jul", "Ago.", "Set.", "Oct", "Nov.", "Dic.")])
    de = F.array(*[F.lit(m) for m in ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober",
                                      "November", "Dezember")])
    return t.orders.select(
        "o_orderkey",
        us_date_or_same(F.when(k % 11 == 0, F.lit("31-12")).otherwise(F.date_format(d, "M/d/yyyy"))).alias("us_date"),
        slash_date(F.when(k % 7 == 0, F.lit("31/02/2020")).otherwise(F.date_format(d, " dd/MM/yyyy"))).alias("slash_date"),
        dotted_date(F.when(k % 5 == 0, F.lit("Oslo")).otherwise(F.date_format(d, "d.M.yyyy"))).alias("dotted_date"),
        slash_date_or_same(F.when(k % 3 == 0, F.lit(" soon ")).otherwise(F.date_format(d, "dd/MM/yyyy"))).alias("lenient_date"),
        spanish_month_date(F.concat(F.dayofmonth(d), F.lit(" "), F.element_at(es, month), F.lit(" "), F.year(d))).alias("spanish_date"),
        german_edition_date(F.concat(F.lit("Liste vom "), F.dayofmonth(d), F.lit(". "), F.element_at(de, month), F.lit(" "), F.year(d))).alias("german_date"),
        iso_date(F.when(k % 2 == 0, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "yyyyMMdd"))).alias("strict_date"),
    )


@query("code_labels", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' ELSE o_orderstatus END AS label FROM orders""")
def code_labels(t: Tables) -> DataFrame:
    """Code to label, unknown codes pass through."""
    return t.orders.select("o_orderkey", code_label(F.col("o_orderstatus"), {"O": "Open", "F": "Filled"}).alias("label"))


@query("flag_labels", """
SELECT l_orderkey, l_linenumber, l_partkey, nullif(concat_ws(', ', CASE WHEN l_returnflag = 'R' THEN 'Returned' END,
  CASE WHEN l_linestatus = 'F' THEN 'Final' END, CASE WHEN l_quantity > 25 THEN 'Bulk' END), '') AS labels FROM lineitem""")
def flag_labels_query(t: Tables) -> DataFrame:
    """Flags to an ordered label list."""
    flags = [(F.col("l_returnflag") == "R", "Returned"), (F.col("l_linestatus") == "F", "Final"), (F.col("l_quantity") > 25, "Bulk")]
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", flag_labels(flags).alias("labels"))


@query("scalar_coercion", """
SELECT c_custkey, c_custkey // 1 AS whole, c_acctbal AS amount, 'S' || c_nationkey AS region,
       CASE c_custkey % 3 WHEN 0 THEN 'h' || c_custkey || '.net' END AS host, 'A,B,' || chr((67 + c_custkey % 20)::INT) AS modules
FROM customer""")
def scalar_coercion(t: Tables) -> DataFrame:
    """Tolerant numbers, first subdivision, bare hosts, module letters."""
    k = F.col("c_custkey")
    host = F.when(k % 3 == 0, F.concat(F.lit(" h"), k, F.lit(".net "))).when(k % 3 == 1, F.lit("https://x.net/")).otherwise(F.lit("a b"))
    return t.customer.select(
        "c_custkey", to_whole(F.concat(k, F.lit(".75 "))).alias("whole"),
        to_double(F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(",")), decimal_comma=True).alias("amount"),
        first_subdivision(F.concat(F.lit("XX-S"), F.col("c_nationkey"), F.lit(",YY-T"))).alias("region"),
        bare_host(host).alias("host"),
        F.array_join(module_letters(F.array(F.char(F.lit(99) + k % 20), F.lit("b"), F.lit(" a "), F.lit("B"), F.lit("no"), F.lit("1"))), ",").alias("modules"),
    )


@query("name_split", """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 THEN 'Dr. ' || A ELSE A END AS first,
       CASE p_partkey % 3 WHEN 0 THEN 'von der ' || B WHEN 1 THEN B || ' jun.' ELSE 'Otto geb. ' || B END AS last,
       B AS eastern_first, A AS eastern_last, A || ' ' || B AS town
FROM (SELECT p_partkey, upper(string_split(p_name, ' ')[1][1]) || string_split(p_name, ' ')[1][2:] AS A,
             upper(string_split(p_name, ' ')[2][1]) || string_split(p_name, ' ')[2][2:] AS B FROM part)""")
def name_split(t: Tables) -> DataFrame:
    """Western and eastern name splits and town cleanup."""
    part = t.part.select("p_partkey", F.initcap("p_name").alias("n"))
    a, b, k = F.split_part("n", F.lit(" "), F.lit(1)), F.split_part("n", F.lit(" "), F.lit(2)), F.col("p_partkey") % 3
    west = (
        F.when(k == 0, F.concat(a, F.lit(" von der "), b)).when(k == 1, F.concat(F.lit("Dr. "), a, F.lit(" "), b, F.lit(" jun.")))
        .otherwise(F.concat(a, F.lit("  Otto geb. "), b))
    )
    s = part.select(
        "p_partkey", split_western_name(west).alias("w"), split_eastern_name(F.concat(F.lit("ifj. Dr. "), a, F.lit(" "), b)).alias("e"),
        town_only(F.concat(a, F.lit("  "), b, F.when(k == 0, " 12 B").when(k == 1, " ul. Polna 3").otherwise(","))).alias("town"),
    )
    return s.select("p_partkey", F.col("w.first").alias("first"), F.col("w.last").alias("last"), F.col("e.first").alias("eastern_first"),
                    F.col("e.last").alias("eastern_last"), "town")


# --- address detectors ------------------------------------------------------------------------

# Every line of every document, five of six turned into address-like shapes.
LINES_SQL = r"""
lines AS (SELECT doc_id, line_no, CASE (doc_id + line_no) % 6 WHEN 0 THEN l
    WHEN 1 THEN (doc_id % 900 + 1) || ' ' || l || ' Rd' WHEN 2 THEN 'Calle ' || l || ' ' || line_no
    WHEN 3 THEN l || ' lote ' || line_no WHEN 4 THEN doc_id::VARCHAR
    ELSE l || ', ' || line_no || ' Example Av' END AS v
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
        FROM documents))"""


def _lines(t: Tables) -> DataFrame:
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "l"))
    l, n, k = F.col("l"), F.col("line_no"), (F.col("doc_id") + F.col("line_no")) % 6
    value = (
        F.when(k == 0, l).when(k == 1, F.concat(F.col("doc_id") % 900 + 1, F.lit(" "), l, F.lit(" Rd")))
        .when(k == 2, F.concat(F.lit("Calle "), l, F.lit(" "), n))
        .when(k == 3, F.concat(l, F.lit(" lote "), n)).when(k == 4, F.col("doc_id").cast("string"))
        .otherwise(F.concat(l, F.lit(", "), n, F.lit(" Example Av")))
    )
    return lines.select("doc_id", n.cast("bigint").alias("line_no"), value.alias("v"))


_W = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"
_S = r"\s\x{85}\p{Z}"
_SQL_DIGITS = rf"^[{_S}]*\p{{Nd}}[\p{{Nd}}{_S}-]*$"
_SQL_PLOT = rf"(?i)(^|[^{_W}])(" + "|".join(PLOT_WORDS) + rf")\.?[{_S}]*\p{{Nd}}"
_SQL_NUMBER = rf"(?i)(^|[{_S}])\p{{Nd}}+[{_S}]?[a-z]?([^{_W}]|$)"
_SQL_SUFFIX = rf"(?i)(" + "|".join(STREET_SUFFIXES).replace(".", r"\.") + rf")([^{_W}]|$)"
_SQL_WORD = rf"(?i)(^|[{_S}])(" + "|".join(STREET_WORDS).replace(".", r"\.") + rf")([{_S}]|$)"


def _sql_words(x: str) -> str:
    return f"trim(regexp_replace(upper(replace({x}, 'ß', 'ss')), '[^0-9A-Z#]+', ' ', 'g'))"


def _sql_house(x: str, words) -> str:
    return f"regexp_matches({_sql_words(x)}, '^[0-9]+([A-Z]|ST|ND|RD|TH)? ([^ ]+ )*(" + "|".join(words) + ")( |$)')"


def _sql_looks(x: str) -> str:
    return (
        f"(regexp_matches({x}, '{_SQL_DIGITS}') OR regexp_matches({x}, '{_SQL_PLOT}') OR (regexp_matches({x}, '{_SQL_NUMBER}')"
        f" AND (regexp_matches({x}, '{_SQL_SUFFIX}') OR regexp_matches({x}, '{_SQL_WORD}'))) OR {_sql_house(x, STREET_TYPES)})"
    )


@query("address_scrub", f"WITH {LINES_SQL} SELECT doc_id, line_no, {_sql_looks('v')} AS is_address FROM lines")
def address_scrub(t: Tables) -> DataFrame:
    """Address shape of every document line."""
    return _lines(t).select("doc_id", "line_no", looks_like_street_address(F.col("v")).alias("is_address"))


_LEAD = r"^([0-9]{1,4}([A-Za-z]|-[0-9]{1,4}[A-Za-z]?|/[0-9]{1,4})?)[\s\x{85}\p{Z}]+([A-Za-z]+)"


@query("location_scrub", f"""WITH {LINES_SQL},
parts AS (SELECT doc_id, line_no, regexp_replace(unnest(string_split(v, ',')), '^[{_S}]+|[{_S}]+$', '', 'g') AS p FROM lines),
judged AS (SELECT doc_id, line_no, bool_or(NOT regexp_matches(p, '{_SQL_DIGITS}') AND ({_sql_looks('p')} OR {_sql_house('p', ('AV',))}
   OR (regexp_extract(p, '{_LEAD}', 1) <> '' AND NOT regexp_matches(regexp_extract(p, '{_LEAD}', 1), '[mM]$')
       AND upper(regexp_extract(p, '{_LEAD}', 3)) NOT IN ({", ".join(repr(u) for u in UNIT_WORDS)})))) AS bad FROM parts GROUP BY 1, 2)
SELECT doc_id, line_no, {_sql_looks('v')} OR bad AS is_address FROM lines JOIN judged USING (doc_id, line_no)""")
def location_scrub(t: Tables) -> DataFrame:
    """Address inside a free-text location, part by part."""
    return _lines(t).select("doc_id", "line_no", location_has_street_address(F.col("v")).alias("is_address"))


@query("echo_scrub", """
SELECT c_custkey, c_custkey % 4 <> 3 AS echoes FROM customer""")
def echo_scrub(t: Tables) -> DataFrame:
    """Published values that repeat the row's street."""
    k, name = F.col("c_custkey") % 4, F.col("c_name")
    street = F.concat(F.col("c_custkey") + 100, F.lit(" Sample Ct."))
    value = (
        F.when(k == 0, F.upper(street)).when(k == 1, F.concat(street, F.lit(" "), name))
        .when(k == 2, F.substring(F.concat(F.col("c_custkey") + 1000, F.lit(" example water cove")), 1, 20)).otherwise(name)
    )
    other = F.when(k == 2, F.concat(F.col("c_custkey") + 1000, F.lit(" EXAMPLE WATER COVE"))).otherwise(F.lit("Pawleys Island"))
    return t.customer.select("c_custkey", echoes_street(value, [street, other, F.lit(None).cast("string")]).alias("echoes"))


_EMAIL_SQL = EMAIL_PATTERN


@query("email_redact", f"""
SELECT doc_id, md5(regexp_replace(text, '{_EMAIL_SQL}', '{EMAIL_PLACEHOLDER}', 'g')) AS digest,
       length(regexp_extract_all(text, '{_EMAIL_SQL}'))::BIGINT AS n FROM documents""")
def email_redact(t: Tables) -> DataFrame:
    """E-mail addresses replaced in whole texts."""
    return t.documents.select(
        "doc_id", F.md5(redact_emails(F.col("text"))).alias("digest"),
        count_emails(F.col("text")).alias("n"),
    )


_ORG = "|".join(ORGANISATION_WORDS)


@query("withhold_person", rf"""
SELECT c_custkey, CASE WHEN NOT person THEN name END AS last_name, person FROM (
  SELECT c_custkey, name, CASE WHEN kind IN ('1', '2', '3', '4', '5') THEN false WHEN kind = '6' THEN
    regexp_matches(name, '(?i)^\s*(nominee|attn|attention|c/-|c/o)\b') OR NOT regexp_matches(name, '(?i)\b({_ORG})\b') ELSE true END AS person
  FROM (SELECT c_custkey, (c_nationkey % 9)::VARCHAR AS kind, CASE c_custkey % 3 WHEN 0 THEN c_mktsegment || ' Radio Club'
        WHEN 1 THEN 'Nominee ' || c_name || ' club' ELSE c_name END AS name FROM customer))""")
def withhold_person(t: Tables) -> DataFrame:
    """Natural-person decision and the withheld name."""
    k = F.col("c_custkey") % 3
    name = F.when(k == 0, F.concat("c_mktsegment", F.lit(" Radio Club"))).when(k == 1, F.concat(F.lit("Nominee "), "c_name", F.lit(" club"))).otherwise(F.col("c_name"))
    who = t.customer.select("c_custkey", name.alias("name"), is_natural_person((F.col("c_nationkey") % 9).cast("string"), name).alias("person"))
    return who.select("c_custkey", F.when(~F.col("person"), F.col("name")).alias("last_name"), "person")


@query("callsign_rejects", rf"""
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN regexp_matches(c, '{RECIPROCAL_SHAPE}') THEN 'visitor' WHEN NOT regexp_matches(c, '{CALLSIGN_SHAPES["ursec"]}') THEN 'shape'
         ELSE 'accepted' END AS reason
  FROM (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'CX' || (o_orderkey % 10) || 'AB' WHEN 1 THEN 'K' || (o_orderkey % 10) || 'ABC/CX'
        ELSE 'K' || o_orderkey END AS c FROM orders)) GROUP BY 1""")
def callsign_rejects(t: Tables) -> DataFrame:
    """Accepted and rejected callsigns by reason."""
    k, d = F.col("o_orderkey") % 4, F.col("o_orderkey") % 10
    call = F.when(k == 0, F.concat(F.lit("CX"), d, F.lit("AB"))).when(k == 1, F.concat(F.lit("K"), d, F.lit("ABC/CX"))).otherwise(call_of("o_orderkey"))
    reason = F.when(call.rlike(RECIPROCAL_SHAPE), "visitor").when(~call.rlike(CALLSIGN_SHAPES["ursec"]), "shape").otherwise("accepted")
    return t.orders.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("entity_decode", """
SELECT c_custkey, 'O''' || c_name || ' & ' || c_mktsegment || chr(233) AS decoded FROM customer""")
def entity_decode(t: Tables) -> DataFrame:
    """Numeric references decoded, other ampersands kept."""
    raw = F.concat(F.lit("O&#x27;"), "c_name", F.lit(" & "), "c_mktsegment", F.lit("&#233;"))
    return t.customer.select("c_custkey", decode_numeric_entities(raw).alias("decoded"))


# --- scans over text columns ------------------------------------------------------------------


@query("html_rows", r"""
SELECT page_id, row_no - 1 AS row_no, cell FROM (
  SELECT page_id, generate_subscripts(items, 1) AS row_no,
         trim(regexp_replace(regexp_replace(unnest(items), '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS cell
  FROM (SELECT page_id, regexp_extract_all(html, '(?is)<li>(.*?)</li>', 1) AS items FROM pages))""")
def html_rows_query(t: Tables) -> DataFrame:
    """Markup rows to cells (list items read as one-cell table rows)."""
    table = F.regexp_replace(F.regexp_replace("html", "(?i)<li>", "<tr><td>"), "(?i)</li>", "</td></tr>")
    rows = html_rows(t.pages.select("page_id", table.alias("html")), "page_id", "html")
    return rows.select("page_id", F.col("row_no").cast("bigint").alias("row_no"), F.element_at("cells", 1).alias("cell"))


@query("line_entries", r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
i AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^[A-M]') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM l)
SELECT doc_id, island::BIGINT AS island, count(*) AS n_lines, md5(list_reduce(list(line ORDER BY line_no),
   lambda a, b: CASE WHEN a = '' OR a LIKE '%-' THEN a || b ELSE a || ' ' || b END)) AS digest
FROM i GROUP BY 1, 2""")
def line_entries(t: Tables) -> DataFrame:
    """Lines assembled into entries; an entry starts at a line with a leading A to M."""
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    islands = number_islands(lines, "doc_id", "line_no", F.col("line").rlike("^[A-M]"), block_lines=64)
    return join_lines(islands, ["doc_id", "island"], "line_no", "line").select(
        "doc_id", "island", "n_lines", F.md5("entry_text").alias("digest")
    )


@query("fixed_width", """
SELECT 'VE' || (c_custkey % 10) || chr((65 + c_custkey % 26)::INT) || chr((65 + c_custkey // 26 % 26)::INT) AS callsign,
  CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS first_name,
  CASE WHEN c_custkey % 5 = 0 THEN 'Club ' || c_custkey ELSE c_name END AS last_name,
  CASE WHEN c_custkey % 5 = 0 THEN 'CITY ' || c_nationkey WHEN c_custkey % 7 = 0 THEN NULL ELSE 'TOWN ' || c_nationkey END AS city,
  CASE WHEN c_custkey % 3 <> 0 THEN 'K' || (c_custkey % 10) || 'A' END AS postal_code,
  nullif(concat_ws(', ', CASE WHEN c_custkey % 2 = 0 THEN 'Basic' END, CASE WHEN c_custkey % 11 = 0 THEN 'Advanced' END), '') AS license_class
FROM customer""")
def fixed_width(t: Tables) -> DataFrame:
    """Fixed-width report lines to records."""
    k = F.col("c_custkey")
    club = k % 5 == 0
    pad = lambda c, n: F.rpad(c.cast("string"), n, " ")
    letter = lambda c: F.char(F.lit(65) + c % 26)
    call = F.concat(F.lit("VE"), k % 10, letter(k), letter(F.floor(k / 26)))
    postal = F.when(k % 3 == 0, F.lit("9021")).otherwise(F.concat(F.lit("k"), k % 10, F.lit("a 0b1")))
    blank = lambda n: F.lit(" " * n)
    base = F.concat(
        pad(call, 7), pad(F.col("c_mktsegment"), 36), pad(F.col("c_name"), 36), pad(F.lit("1 Main St"), 71),
        pad(F.when(k % 7 == 0, F.lit("**")).otherwise(F.concat(F.lit("TOWN "), F.col("c_nationkey"))), 36), pad(F.lit("ON"), 3), pad(postal, 11),
        F.when(k % 2 == 0, "A").otherwise(" "), blank(5), F.when(k % 11 == 0, "D").otherwise(" "), blank(3),
    )
    tail = F.concat(
        pad(F.concat(F.lit("Club "), k), 71), blank(71), pad(F.lit("2 Club Rd"), 71),
        pad(F.concat(F.lit("CITY "), F.col("c_nationkey")), 36), pad(F.lit("QC"), 3), pad(postal, 7),
    )
    lines = t.customer.select(F.when(club, F.concat(base, tail)).otherwise(base).alias("value"))
    return ca_records(lines).select("callsign", "first_name", "last_name", "city", "postal_code", "license_class")


@query("csv_by_name", """
SELECT o_orderkey::VARCHAR AS licence_no, o_custkey::VARCHAR AS client_no,
       CASE WHEN o_orderkey % 2 = 0 THEN 'say "' || o_orderpriority || '",' || chr(10) || 'ok' ELSE o_orderpriority END AS type_name FROM orders""")
def csv_by_name(t: Tables) -> DataFrame:
    """CSV files of two layouts: positional without a header, re-ordered with one; quoted cells go over two lines."""
    folder = scratch(t.spark)
    text = F.concat(F.lit('say "'), "o_orderpriority", F.lit('",\nok'))
    even = F.col("o_orderkey") % 2 == 0
    t.orders.filter(even).select("o_orderkey", "o_custkey", F.lit("").alias("none"), text.alias("text")).write.option("escape", '"').csv(f"{folder}/plain")
    headed = t.orders.filter(~even).select(F.col("o_orderpriority").alias("TYPE_NAME"), F.col("o_orderkey").alias("licence_no"), F.lit(" x ").alias("OTHER"), F.col("o_custkey").alias("CLIENT_NO"))
    headed.write.option("header", True).csv(f"{folder}/headed")
    # The header is recognised by its first cell.
    return table(t.spark, f"{folder}/*", {"licence_no": 0, "client_no": 1, "type_name": 3}, header_tokens={"type_name"}).drop("_ord")


@query("json_flatten", """
SELECT 'M17-' || event_id AS id, event_type AS name, CASE WHEN event_id % 2 = 0 THEN 'h' || user_id || '.net' ELSE '10.0.0.' || user_id END AS host,
       (regexp_extract(props, '[0-9]+'))::BIGINT AS port, 'A,' || chr((66 + event_id % 20)::INT) AS modules FROM events""")
def json_flatten(t: Tables) -> DataFrame:
    """Row lists out of four envelope shapes, numbers and strings alike."""
    e = t.events
    row = F.to_json(F.struct(
        F.col("event_id").alias("designator"), F.col("event_type").alias("name"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("h"), "user_id", F.lit(".net"))).alias("dns"),
        F.concat(F.lit("10.0.0."), "user_id").alias("ipv4"), F.get_json_object("props", "$.k").cast("int").alias("port"),
        F.array(F.char(F.lit(98) + F.col("event_id") % 20), F.lit("a")).alias("modules"),
    ))
    k = F.col("event_id") % 4
    payload = (
        F.when(k == 0, F.concat(F.lit('{"data":{"reflectors":['), row, F.lit("]}}"))).when(k == 1, F.concat(F.lit('{"data":['), row, F.lit("]}")))
        .when(k == 2, F.concat(F.lit("["), row, F.lit("]"))).otherwise(F.concat(F.lit('{"results":['), row, F.lit("]}")))
    )
    flat = network_records(e.select(payload.alias("payload")), "m17")
    return flat.select("id", "name", "host", "port", F.array_join("modules", ",").alias("modules"))


@query("json_servers", """
SELECT 'srv-' || s_suppkey || '-' || k AS id, 'net-' || s_nationkey AS system, s_name AS sponsor,
       CASE WHEN k = 0 THEN 'h' || s_suppkey || '.net' ELSE '10.1.' || s_suppkey END AS host, (62000 + k)::BIGINT AS port
FROM supplier, (SELECT unnest([0, 1]) AS k)""")
def json_servers(t: Tables) -> DataFrame:
    """Networks to servers; the parent's fields are inherited, URLs are no hosts."""
    def server(k: int):
        dns = F.concat(F.lit("h"), "s_suppkey", F.lit(".net")) if k == 0 else F.lit("https://dash.net/")
        return F.struct(
            F.concat(F.lit("srv-"), "s_suppkey", F.lit(f"-{k}")).alias("slug"), dns.alias("dns"),
            F.concat(F.lit("10.1."), "s_suppkey").alias("ipv4"), F.lit(62000 + k).alias("port"),
        )

    net = F.struct(F.concat(F.lit("net-"), "s_nationkey").alias("slug"), F.col("s_name").alias("network"), F.array(server(0), server(1)).alias("servers"))
    payload = F.to_json(F.struct(F.struct(F.array(net).alias("networks")).alias("data")))
    return server_records(t.supplier.select(payload.alias("payload"))).select("id", "system", "sponsor", "host", "port")


@query("json_talkgroups", """
SELECT 'net-' || p_partkey AS system, (p_size + k)::BIGINT AS tg, p_name || ' ' || k AS name
FROM part, (SELECT unnest([0, 1]) AS k)""")
def json_talkgroups(t: Tables) -> DataFrame:
    """Talkgroup lists one level deeper, first row per number."""
    group = lambda k, name: F.struct((F.col("p_size") + k).alias("tg"), name.alias("name"))
    groups = F.array(group(0, F.concat("p_name", F.lit(" 0"))), group(1, F.concat("p_name", F.lit(" 1"))), group(0, F.lit("again")))
    shape = F.struct(F.struct(F.struct(groups.alias("talkgroups")).alias("network")).alias("data"))
    payloads = t.part.select(F.concat(F.lit("net-"), "p_partkey").alias("system"), F.to_json(shape).alias("payload"))
    return talkgroup_rows(payloads).select("system", "tg", "name")


@query("entity_table", """
SELECT upper(p_type) || p_partkey AS key, false AS is_exact, p_name AS entity, p_partkey AS number FROM part
UNION ALL SELECT upper(p_brand) || '/' || p_partkey, true, p_name, p_partkey FROM part""")
def entity_table(t: Tables) -> DataFrame:
    """Prefix records with header, annotated tokens and exact marks."""
    text = F.concat(
        "p_name", F.lit(":  05: 08: NA: 1.0: 2.0: 5.0:  "), F.concat(F.lit("p"), F.col("p_partkey")), F.lit(":\n    "),
        F.lower("p_type"), F.col("p_partkey"), F.lit("(05)[08],\n  ="), "p_brand", F.lit("/"), F.col("p_partkey"), F.lit("<1/2>{NA}"),
    )
    chunks = t.part.select(text.alias("value"), F.struct("p_partkey").alias("_ord"))
    numbers = t.part.select(F.concat(F.lit("P"), "p_partkey").alias("primary"), F.col("p_partkey").alias("number"))
    return entity_keys(chunks, numbers)


@query("node_report", """
WITH l AS (SELECT o_orderkey, o_custkey, o_orderkey % 10 AS k FROM orders),
ok AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM l WHERE k NOT IN (0, 1))
SELECT 'field_count' AS reason, count(*) AS n FROM l WHERE k = 0 UNION ALL SELECT 'node_number', count(*) FROM l WHERE k = 1
UNION ALL SELECT 'duplicate', count(*) FROM ok WHERE rn > 1 UNION ALL SELECT 'address', count(*) FROM ok WHERE rn = 1 AND k = 2""")
def node_report_query(t: Tables) -> DataFrame:
    """Strict directory lines: drops and blanked locations by reason."""
    k = F.col("o_orderkey") % 10
    place = F.when(k == 2, F.concat(F.lit("Anytown, IA, "), F.col("o_orderkey") % 900 + 1, F.lit(" Example St"))).otherwise(F.lit("Des Moines, Iowa"))
    line = (
        F.when(k == 0, F.concat_ws("|", "o_custkey", "o_orderkey", F.lit("x"))).when(k == 1, F.concat_ws("|", F.lit("n/a"), "o_orderkey", F.lit("x"), F.lit("y")))
        .otherwise(F.concat_ws("|", "o_custkey", F.concat(F.lit("k"), "o_orderkey"), F.lit("mail a@b.org"), place))
    )
    report = node_report(t.orders.select(line.alias("value"), F.struct("o_orderkey").alias("_ord")))
    return node_drop_counts(report)


@query("name_similarity")
def name_similarity(t: Tables) -> DataFrame:
    """Ratcliff/Obershelp ratio of each part's name against its own label."""
    pairs = t.part.select(
        boundary_name(F.col("p_name")).alias("a"), boundary_name(F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(" "), "p_type")).alias("b")
    ).distinct()
    return pairs.withColumn("ratio", name_ratio("a", "b"))


@query("boundary_names", """
SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'nation ' || s_nationkey || ' national forest'
  WHEN 1 THEN 'nation ' || s_nationkey || ' state park' ELSE 'nf nation ' || s_nationkey END AS name FROM supplier""")
def boundary_names(t: Tables) -> DataFrame:
    """Boundary names with their tails spelled out."""
    k = F.col("s_suppkey") % 3
    raw = F.concat(F.when(k == 2, F.lit(" NF  ")).otherwise(F.lit("  ")), F.lit("Nation  "), F.col("s_nationkey"),
                   F.when(k == 0, " NF").when(k == 1, " SP ").otherwise(" "))
    return t.supplier.select("s_suppkey", boundary_name(raw).alias("name"))


