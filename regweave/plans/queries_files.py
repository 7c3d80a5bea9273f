"""Readers and sinks on whole files: tables are written in a publisher's layout and read by the library's own reader."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave import sinks
from regweave.functions.labels import CALLSIGN_SHAPES
from regweave.functions.text import repair_controls
from regweave.operators.assemble import callbook_entries
from regweave.operators.dedupe import union_all
from regweave.operators.guards import require_columns
from regweave.plans.builds import collect_streams
from regweave.plans.catalog import Tables, query
from regweave.plans.inputs import call_of, customer_state, iso_day, scratch, state_sql
from regweave.plans.inputs import registers as registers_of
from regweave.schemas import HISTORY, RECORD, TALKGROUP
from regweave.session import stored
from regweave.sources import directory, reference, registers

ROWS_A_FILE = 5000


def letters(key: str) -> str:
    """Four letters of a key, for SQL of both engines."""
    return " || ".join(f"chr(cast(65 + floor({key} / {n}) % 26 as int))" for n in (17576, 676, 26, 1))


def lines_with_heads(lines: DataFrame, folder: str, *heads: str, encoding: str = "UTF-8") -> str:
    """Text files of at most ``ROWS_A_FILE`` keys, each with its head lines on top, in order of ``k``; returns their pattern.

    ``lines`` has ``k`` and ``value``; each key range is a file of its own.
    """
    parts = lines.select(F.floor(F.col("k") / ROWS_A_FILE).alias("part"), "k", "value")
    top = parts.select("part").distinct()
    tops = [top.select("part", F.lit(i - len(heads)).cast("bigint").alias("k"), F.lit(h).alias("value")) for i, h in enumerate(heads)]
    whole = union_all([parts, *tops]).repartition("part").sortWithinPartitions("part", "k")
    whole.select("part", "value").write.partitionBy("part").text(folder)
    return f"{folder}/part=*"


# --- registers ---------------------------------------------------------------------------------


@query("fcc_files", """
SELECT 'K' || o_orderkey AS callsign, o_orderpriority AS first_name, 'NAME ' || o_custkey AS last_name,
  CASE o_orderkey % 4 WHEN 0 THEN 'Amateur Extra' WHEN 1 THEN 'General' WHEN 2 THEN 'Z' ELSE 'Technician' END AS license_class,
  strftime(o_orderdate, '%Y-%m-%d') AS grant_date, CASE WHEN o_custkey % 2 = 0 THEN 'TOWN' END AS city
FROM orders WHERE o_orderstatus = 'O'""")
def fcc_files(t: Tables) -> DataFrame:
    """Pipe files read by position, header and class tables with an older row above, echoes withheld."""
    folder, key = scratch(t.spark), F.col("o_orderkey")

    def pipe(width: int, values: dict) -> F.Column:
        return F.concat_ws("|", *[F.coalesce(values.get(i, F.lit("")).cast("string"), F.lit("")) for i in range(width)])

    head = {0: F.lit("HD"), 1: key, 4: call_of("o_orderkey"), 7: F.date_format("o_orderdate", "MM/dd/yyyy")}
    old, new = F.lit("E"), F.when(F.col("o_orderstatus") == "O", "A").otherwise("C")
    street = F.lit("9 Echo Lane")
    entity = {0: F.lit("EN"), 1: key, 4: call_of("o_orderkey"), 8: F.concat(F.lit("  "), "o_orderpriority"), 10: F.concat(F.lit("NAME "), "o_custkey"),
              15: street, 16: F.when(F.col("o_custkey") % 2 == 0, "TOWN").otherwise(street)}
    klass = F.element_at(F.array(*map(F.lit, ("E", "G", "Z", "T"))), (key % 4 + 1).cast("int"))
    for name, rows in (
        ("HD.dat", [pipe(43, head | {5: old}), pipe(43, head | {5: new})]), ("EN.dat", [pipe(24, entity)]),
        ("AM.dat", [pipe(16, {1: key, 5: F.lit("A")}), pipe(6, {1: key, 5: klass})]),
    ):
        t.orders.select(F.explode(F.array(*rows)).alias("value")).write.text(f"{folder}/{name}")
    return registers.read_us(t.spark, folder).select("callsign", "first_name", "last_name", "license_class", "grant_date", "city")


@query("acma_files", """
SELECT 'VK' || o_orderkey AS callsign, CASE WHEN o_custkey % 3 = 0 THEN c_name || ' "Club", Inc' END AS last_name, o_orderpriority AS license_class,
  strftime(o_orderdate, '%Y-%m-%d') AS grant_date, CASE o_custkey % 3 WHEN 0 THEN 'Firm' WHEN 1 THEN 'Human' END AS applicant_type,
  CASE WHEN o_custkey % 3 = 0 THEN 'TOWN ' || c_nationkey END AS city
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 5 <> 0 AND o_orderstatus <> 'F'""")
def acma_files(t: Tables) -> DataFrame:
    """CSV set of four files, one without a header, a name over two lines; particulars of persons withheld."""
    folder, key = scratch(t.spark), F.col("o_orderkey")
    licence = F.concat(F.lit("L"), key)
    t.customer.select(
        F.col("c_custkey").alias("CLIENT_NO"), F.concat("c_name", F.lit('\n"Club", Inc')).alias("LICENCEE"), F.lit("PO Box 1").alias("POSTAL_STREET"),
        F.concat(F.lit("TOWN "), "c_nationkey").alias("POSTAL_SUBURB"), F.lit("NSW").alias("POSTAL_STATE"), F.lit("2000").alias("POSTAL_POSTCODE"),
        F.element_at(F.array(F.lit("5"), F.lit("7"), F.lit("")), (F.col("c_custkey") % 3 + 1).cast("int")).alias("CLIENT_TYPE_ID"),
    ).write.options(header=True, escape='"').csv(f"{folder}/client.csv")
    none = [F.lit("").alias(f"n{i}") for i in range(3)]
    t.orders.select(
        licence.alias("a"), F.col("o_custkey").alias("b"), none[0], none[1], F.when(key % 5 == 0, "Land Mobile").otherwise("Amateur").alias("c"),
        F.col("o_orderpriority").alias("d"), iso_day("o_orderdate").alias("e"), F.lit("x").alias("f"), F.lit("y").alias("g"), none[2],
        F.when(F.col("o_orderstatus") == "F", "Cancelled").otherwise("GRANTED").alias("h"),
    ).write.options(emptyValue="").csv(f"{folder}/licence.csv")
    t.orders.select(F.lit("s").alias("SDD_ID"), F.lower(F.concat(F.lit("vk"), key)).alias("CALL_SIGN"), licence.alias("LICENCE_NO")).write.option("header", True).csv(f"{folder}/device_details.csv")
    kinds = t.nation.select(F.element_at(F.array(F.lit("5"), F.lit("7")), (F.col("n_nationkey") % 2 + 1).cast("int")).alias("TYPE_ID")).distinct()
    kinds.withColumn("NAME", F.when(F.col("TYPE_ID") == "5", "Firm").otherwise("Human")).write.option("header", True).csv(f"{folder}/client_type.csv")
    return registers.read_au(t.spark, folder).select("callsign", "last_name", "license_class", "grant_date", "applicant_type", "city")


@query("anatel_files", f"""
SELECT 'P' || chr((80 + c_custkey // 175760 % 10)::INT) || (c_custkey % 10) || substr({letters("(c_custkey // 10)")}, 2) AS callsign,
  c_name || ' "x", ok' AS last_name, CASE WHEN c_custkey % 4 = 0 THEN 'Fixed ' || c_nationkey ELSE 'Mobile ' || c_nationkey END AS city,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS license_class, '1999-12-0' || (1 + c_custkey % 9) AS grant_date,
  '2031-01-02' AS expired_date, CASE c_custkey % 2 WHEN 0 THEN 'Individual' ELSE 'Organization' END AS applicant_type FROM customer""")
def anatel_files(t: Tables) -> DataFrame:
    """Semicolon CSV in two column orders with a byte-order mark, quoted line breaks, two stations a holder."""
    folder, k = scratch(t.spark), F.col("c_custkey")
    call = F.expr(f"concat('P', chr(80 + floor(c_custkey / 175760) % 10), c_custkey % 10, substr({letters('floor(c_custkey / 10)')}, 2))")
    base = t.customer.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("station"))
    fixed = (F.col("station") == 1) & (k % 4 == 0)
    values = {
        "Tipo de Identificação": F.when(k % 2 == 0, "CPF").otherwise("CNPJ"), "Nome da Entidade": F.concat("c_name", F.lit(' "x",\n ok')),
        "Indicativo": F.lower(call), "UF da Entidade": F.lit("SP"), "COER": F.when(k % 5 == 0, "N/A").otherwise(F.col("c_mktsegment")),
        "Tipo de Estação": F.when(fixed, "Fixa").otherwise("Móvel"), "Município da Estação": F.concat(F.when(fixed, "Fixed ").otherwise("Mobile "), "c_nationkey"),
        "UF da Estação": F.lit("RJ"), "Data do Primeiro Licenciamento": F.concat(1 + k % 9, F.lit("/12/"), 1999 + F.col("station")),
        "Data do Último Licenciamento": F.lit("05/06/2020"), "Data de Validade da Estação": F.when(F.col("station") == 1, "2/1/2031").otherwise("31/02/2040"),
    }
    for half, names in enumerate((list(values), list(values)[::-1])):
        rows = base.filter(k % 2 == half).repartition("c_custkey").sortWithinPartitions("c_custkey", "station")
        columns = [values[n].cast("string").alias(n) for n in names]
        columns[0] = columns[0].alias("﻿" + names[0])
        rows.select(*columns).write.options(header=True, sep=";", escape='"').csv(f"{folder}/{half}")
    out = registers.read_br(t.spark, f"{folder}/*")
    return out.select("callsign", "last_name", "city", "license_class", "grant_date", "expired_date", "applicant_type")


@query("nkom_files", f"""
SELECT 'LA' || (c_custkey % 1000) || {letters("(c_custkey // 1000)")} AS callsign, CASE WHEN c_custkey % 3 <> 0 THEN 'Kåre' END AS first_name,
  CASE WHEN c_custkey % 3 = 0 THEN 'Klubb "' || c_name ELSE c_name END AS last_name, CASE WHEN c_custkey % 5 <> 0 THEN 'Ås ' || c_nationkey END AS city,
  '2030-02-28' AS expired_date, CASE c_custkey % 3 WHEN 0 THEN 'Organisation' ELSE 'Person' END AS applicant_type FROM customer""")
def nkom_files(t: Tables) -> DataFrame:
    """Semicolon files without quoting, one file per key range; organisations replace persons, foreign towns go."""
    k = F.col("c_custkey")
    club = k % 3 == 0
    value = F.concat_ws(
        ";", F.expr(f"concat('la', c_custkey % 1000, {letters('floor(c_custkey / 1000)')})"), F.when(club, F.concat(F.lit('Klubb "'), "c_name")).otherwise(""),
        F.lit("Kåre"), "c_name", F.lit("Vei 1"), F.lit(""), F.lit("0123"), F.concat(F.lit("Ås "), "c_nationkey"),
        F.when(k % 5 == 0, "Sverige").otherwise("Norge"), F.when(club, "Organisasjon").otherwise("personlig"), F.lit("28.02.2030"))
    value = F.when(club, F.regexp_replace(value, ";Kåre;", ";;")).otherwise(value)
    files = lines_with_heads(t.customer.select(k.alias("k"), value.alias("value")), scratch(t.spark), ";".join(registers.NO_COLUMNS))
    return registers.read_no(t.spark, files).select("callsign", "first_name", "last_name", "city", "expired_date", "applicant_type")


@query("uke_files", """
WITH r AS (SELECT 'SP' || p_partkey || 'A' AS callsign, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE 'Klub ' || p_brand END AS last_name,
  'Łódź' AS city, CASE WHEN p_size % 2 = 0 THEN 'Category 1' ELSE 'Dx' END AS license_class, '2030-01-' || lpad((1 + p_size % 28)::VARCHAR, 2, '0') AS expired_date,
  CASE WHEN p_partkey % 2 = 0 THEN 'Individual' ELSE 'Club' END AS applicant_type, p_partkey AS k FROM part)
SELECT callsign, last_name, city, license_class, CASE WHEN k % 10 = 0 THEN '2031-01-01' ELSE expired_date END AS expired_date,
  CASE WHEN k % 10 = 0 THEN 'Unattended station' ELSE applicant_type END AS applicant_type FROM r""")
def uke_files(t: Tables) -> DataFrame:
    """Four exports with tags; the latest expiry of a callsign wins over all of them."""
    folder, k = scratch(t.spark), F.col("p_partkey")
    call = F.concat(F.lit("sp"), k, F.lit("a"))
    rows = t.part.select(
        k, call.alias("call_sign"), F.concat(F.lit("2030-01-"), F.lpad((1 + F.col("p_size") % 28).cast("string"), 2, "0")).alias("valid_to"),
        F.when(F.col("p_size") % 2 == 0, "Kategoria1").otherwise("Dx").alias("category"), F.lit("Łódź ul. Nowa 3").alias("station_location"),
        F.when(k % 2 == 0, F.col("p_name")).otherwise(F.concat(F.lit("Klub "), "p_brand")).alias("applicant_name"))
    late = rows.filter(k % 10 == 0).withColumn("valid_to", F.lit("2031-01-01"))
    early = rows.withColumn("valid_to", F.lit("2029-05-05"))
    for name, part in (("individuals.csv", rows.filter(k % 2 == 0)), ("clubs.csv", rows.filter(k % 2 == 1)), ("individual_devices.csv", late), ("club_devices.csv", early)):
        part.drop("p_partkey").write.options(header=True, sep=";", quoteAll=True).csv(f"{folder}/{name}")
    return registers.read_pl(t.spark, folder).select("callsign", "last_name", "city", "license_class", "expired_date", "applicant_type")


@query("nmhh_files", """
SELECT 'HA' || p_partkey || 'A' AS callsign, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'Ödön' END AS first_name,
  CASE WHEN p_partkey % 3 = 0 THEN 'Klub & ' || p_brand ELSE 'Példa' END AS last_name, CASE WHEN p_partkey % 4 <> 0 THEN 'Pécs <' || p_size END AS city,
  CASE WHEN p_partkey % 3 = 0 THEN 'Club' END AS applicant_type, '2031-05-05' AS expired_date FROM part WHERE p_size % 7 <> 0""")
def nmhh_files(t: Tables) -> DataFrame:
    """Spreadsheet XML in two column orders with sparse cells; files of one row a line and files without line breaks."""
    folder, k = scratch(t.spark), F.col("p_partkey")
    club = k % 3 == 0
    values = {
        "Call Sign": F.concat(F.lit("ha"), k, F.lit("a")), "Name of licensee": F.when(club, F.concat(F.lit("Klub &amp; "), "p_brand")).otherwise("Dr. Példa Ödön"),
        "City": F.when(k % 4 != 0, F.concat(F.lit("P<B>éc</B>s &lt;"), "p_size")), "Utca": F.lit(None).cast("string"),
        "Validity": F.lit("2031-05-05T00:00"), "ENG.KAT": F.lit("A"), "Morse": F.lit(None).cast("string"),
        "Felelős kezelő": F.when(club, "Vezető"), "Státusz": F.when(F.col("p_size") % 7 == 0, "Lejárt").otherwise("Kiadott"),
    }

    def row(cells: list) -> F.Column:
        # Every cell says where it stands, so that absent ones can be left out.
        return F.concat(F.lit("<Row>"), *[F.when(c.isNull(), "").otherwise(F.concat(F.lit(f'<Cell ss:Index="{i}"><Data ss:Type="String">'), c, F.lit("</Data></Cell>"))) for i, c in enumerate(cells, 1)], F.lit("</Row>"))

    start = '<?xml version="1.0"?>\n<Workbook xmlns="urn:schemas-microsoft-com:office:spreadsheet" xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet"><Worksheet><Table>'
    for half, names in enumerate((list(values), list(values)[::-1])):
        head = "<Row>" + "".join(f"<Cell><Data>{n}</Data></Cell>" for n in names) + "</Row>"
        part = t.part.filter(k % 2 == half).select(k.alias("k"), row([values[n] for n in names]).alias("value"))
        tail = part.select(F.floor(F.col("k") / ROWS_A_FILE).alias("p")).distinct().select(((F.col("p") + 1) * ROWS_A_FILE - 0.5).alias("k"), F.lit("</Table></Worksheet></Workbook>").alias("value"))
        whole = part.select(F.col("k").cast("double"), "value").unionByName(tail)
        # The second half has head and first row on one line, so its files are read as wholes.
        lines_with_heads(whole, f"{folder}/{half}", *((start, head) if half == 0 else (start + head,)))
    out = registers.read_hu(t.spark, f"{folder}/*/part=*")
    return out.select("callsign", "first_name", "last_name", "city", "applicant_type", "expired_date")


@query("ursec_files", """
SELECT 'CX' || (c_custkey % 10) || chr((65 + c_custkey // 6760 % 26)::INT) || chr((65 + c_custkey // 260 % 26)::INT) || chr((65 + c_custkey // 10 % 26)::INT) AS callsign,
  CASE WHEN c_custkey % 4 <> 0 THEN 'Ana' END AS first_name, c_name AS last_name, 'Superior' AS license_class,
  CASE WHEN c_custkey % 3 = 0 THEN '2029-04-30' ELSE '2030-12-01' END AS expired_date, CASE WHEN c_custkey % 4 <> 0 THEN 'Individual' ELSE 'Organization' END AS applicant_type
FROM customer WHERE c_custkey < 175760""")
def ursec_files(t: Tables) -> DataFrame:
    """Sheet rows with a title line; a visiting permit with a later expiry loses, visitors are dropped.  The keys fill the name space."""
    k = F.col("c_custkey")
    call = F.expr("concat('cx', c_custkey % 10, chr(65 + floor(c_custkey / 6760) % 26), chr(65 + floor(c_custkey / 260) % 26), chr(65 + floor(c_custkey / 10) % 26))")
    row = lambda call, permit, day: F.concat_ws(";", call, F.lit(permit), F.concat(F.lit('"'), "c_name", F.lit('"')), F.when(k % 4 == 0, "").otherwise("Ana"), F.lit("SUPERIOR"), day)
    day = F.when(k % 3 == 0, "30 Abr. 2029").otherwise("2030-12-01")
    lines = t.customer.filter(k < 175760).select(k.alias("k"), F.explode(F.array(
        row(call, "IARP", F.lit("2099-01-01")), row(call, "Permanente", day), row(F.concat(F.lit("K"), k % 10, F.lit("AA/CX")), "", day), F.lit(";;;;;"))).alias("value"))
    files = lines_with_heads(lines, scratch(t.spark), "Radioaficionados al 30/10/2026;;;;;", "Distintivo de llamada;Permiso;Apellidos/Razón social;NOMBRES;Categoría actual;Fecha vencimiento")
    return registers.REGISTERS["ursec"].read(t.spark, files, None).select("callsign", "first_name", "last_name", "license_class", "expired_date", "applicant_type")


@query("bnetza_files", f"""
SELECT 'DA' || (p_partkey % 10) || {letters("(p_partkey // 10)")} AS callsign, 'Eva' AS first_name, CASE WHEN p_partkey % 5 = 0 THEN 'Muster-Mann' ELSE 'Muster' END AS last_name,
  'Ort' || p_size AS city, '38100' AS postal_code, CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'E' END AS license_class, 'Club station' AS applicant_type
FROM part WHERE p_partkey % 7 <> 0""")
def bnetza_files(t: Tables) -> DataFrame:
    """Callbook pages of forty entries, some over two lines with a divided word, some over a page's end; a wrong class is rejected."""
    out = registers.REGISTERS["bnetza"].read(t.spark, _callbook(t), None)
    return out.select("callsign", "first_name", "last_name", "city", "postal_code", "license_class", "applicant_type")


def _callbook(t: Tables) -> str:
    k = F.col("p_partkey")
    call = F.expr(f"concat('DA', p_partkey % 10, {letters('floor(p_partkey / 10)')})")
    klass = F.when(k % 7 == 0, "Q").when(k % 2 == 0, "A").otherwise("E")
    text = F.concat(call, F.lit(", "), klass, F.lit(", Eva Muster"), F.when(k % 5 == 0, "-\nMann").otherwise(""), F.lit("; Weg 1,"), F.when(k % 40 == 39, "\f").otherwise("\n"), F.lit("38100 Ort"), "p_size")
    lines = t.part.select(k.alias("k"), text.alias("value"))
    return lines_with_heads(lines, scratch(t.spark), "Inhalt\n3 Liste der Klubstationen ..... 7\f3 Liste der Rufzeichen der Klubstationen\ngemäß Gesetz\n")


@query("callbook_order", f"""
WITH c AS (SELECT p_partkey AS k, 'DA' || (p_partkey % 10) || {letters("(p_partkey // 10)")} AS callsign FROM part WHERE p_partkey % 7 <> 0)
SELECT callsign AS text, 'out of order' AS problem FROM (SELECT *, lag(callsign) OVER (PARTITION BY k // {ROWS_A_FILE} ORDER BY k) AS before FROM c) WHERE callsign < before""")
def callbook_order(t: Tables) -> DataFrame:
    """Entries that come before their predecessor in the order of callsigns; lines that belong to nothing would be listed too."""
    return callbook_entries(registers.page_lines(t.spark, _callbook(t)))[1].select("text", "problem")


# --- reference tables ----------------------------------------------------------------------------


@query("summit_files", """
SELECT 'G/LD-' || p_partkey AS reference, CASE WHEN p_partkey % 3 = 0 THEN 'Peak, "' || p_name || '"' ELSE p_name END AS name, p_size::BIGINT AS alt_m,
  '2001-02-0' || (1 + p_partkey % 9) AS valid_from, CASE WHEN p_partkey % 4 = 0 THEN '2010-12-31' ELSE '2099-12-31' END AS valid_to,
  p_partkey % 4 <> 0 AS active FROM part""")
def summit_files(t: Tables) -> DataFrame:
    """CSV files with a title above the header, in two column orders."""
    folder, k = scratch(t.spark), F.col("p_partkey")
    cells = dict.fromkeys(reference.SUMMIT_COLUMNS, F.lit("")) | {
        "SummitCode": F.concat(F.lit("G/LD-"), k), "AltM": F.col("p_size").cast("string"), "ValidFrom": F.concat(F.lit("0"), 1 + k % 9, F.lit("/02/2001")),
        "SummitName": F.when(k % 3 == 0, F.concat(F.lit('"Peak, ""'), "p_name", F.lit('"""'))).otherwise(F.col("p_name")),
        "ValidTo": F.when(k % 4 == 0, "31/12/2010").otherwise("31/12/2099"),
    }
    for half, names in enumerate((reference.SUMMIT_COLUMNS, reference.SUMMIT_COLUMNS[::-1])):
        rows = t.part.filter(k % 2 == half).select(k.alias("k"), F.concat_ws(",", *[cells[n] for n in names]).alias("value"))
        lines_with_heads(rows, f"{folder}/{half}", "SOTA Summits List (Date=18/06/2026)", ",".join(names))
    out = reference.read_summits(t.spark, f"{folder}/*/part=*", "2026-06-18")
    return out.select("reference", "name", "alt_m", "valid_from", "valid_to", "active")


@query("park_files", """
SELECT 'US-' || p_partkey AS reference, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN 'ME' ELSE 'Q' END AS region, 'P' || p_size AS country,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size / 2.0 END::DOUBLE AS lat, p_partkey % 5 <> 0 AS active FROM part""")
def park_files(t: Tables) -> DataFrame:
    """JSON arrays, one file per program, the country from the file's name."""
    folder, k = scratch(t.spark), F.col("p_partkey")
    item = F.struct(
        F.concat(F.lit("US-"), k).alias("reference"), F.col("p_name").alias("name"), F.when(k % 3 == 0, "").otherwise((F.col("p_size") / 2).cast("string")).alias("latitude"),
        F.when(k % 2 == 0, "US-ME,US-NH").otherwise("Q").alias("locationDesc"), F.when(k % 2 == 0, (k % 5 != 0).cast("int")).alias("active"),
        F.when(k % 2 == 1, (k % 5 != 0).cast("int")).alias("isActive"))
    lines = t.part.select(F.concat(F.lit("parks_P"), "p_size").alias("program"), F.to_json(item).alias("value"))
    lines.write.partitionBy("program").text(folder)
    return _parks(t, folder).select("reference", "name", "region", "country", "lat", "active")


def _parks(t: Tables, folder: str) -> DataFrame:
    """The written lines as the reader's rows; the name of the folder stands for that of the file."""
    rows = t.spark.read.schema(reference.PARK_JSON).json(f"{folder}/program=*")
    program = F.regexp_extract(F.col("_metadata.file_path"), r"parks_([^/_.]+)", 1)
    return reference.park_records(rows.select("*", program.alias("country"), reference.base.file_order()))


@query("host_files", """
SELECT 'XRF' || lpad(s_suppkey::VARCHAR, 3, '0') AS id, 'h' || s_nationkey || '.net' AS host, 30001::BIGINT AS port FROM supplier
WHERE s_suppkey < 1000 AND s_suppkey % 7 <> 0""")
def host_files(t: Tables) -> DataFrame:
    """Host file with comments, short lines and names of other shapes."""
    folder, k = scratch(t.spark), F.col("s_suppkey")
    line = F.when(k % 7 == 0, F.concat(F.lit("# "), "s_name")).otherwise(F.concat(F.lit(" xrf"), F.when(k < 1000, F.lpad(k.cast("string"), 3, "0")).otherwise(k.cast("string")), F.lit("\t h"), "s_nationkey", F.lit(".net  L")))
    t.supplier.select(F.explode(F.array(line, F.lit(""), F.lit("SHORT"))).alias("value")).write.text(folder)
    return directory.read_hosts(t.spark, folder).select("id", "host", "port")


@query("alias_files", """
SELECT 'h' || (s_suppkey // 3) AS host, 'DCS' || s_suppkey AS name, 0::BIGINT AS file FROM supplier
UNION ALL SELECT 'h' || (s_suppkey // 3), 'REF' || s_suppkey, 1 FROM supplier""")
def alias_files(t: Tables) -> DataFrame:
    """Several host files, the file's place first in the order."""
    folder = scratch(t.spark)
    for name in ("DCS", "REF"):
        t.supplier.select(F.concat(F.lit(name), "s_suppkey", F.lit("   h"), F.floor(F.col("s_suppkey") / 3))).write.text(f"{folder}/{name}")
    out = directory.read_alias_files(t.spark, [f"{folder}/DCS", f"{folder}/REF"])
    return out.select("host", "name", F.col("_ord.path").cast("bigint").alias("file"))


@query("node_pairs", """
SELECT 'K' || l_suppkey AS callsign, l_orderkey AS node, count(*) AS n FROM lineitem WHERE l_linenumber <> 3 GROUP BY 1, 2""")
def node_pairs(t: Tables) -> DataFrame:
    """Lenient node lines of a pipe file: two fields and a number are enough."""
    folder = scratch(t.spark)
    tail = F.when(F.col("l_linenumber") == 1, "").otherwise("|x|y|z")
    number = F.when(F.col("l_linenumber") == 3, "12a").otherwise(F.col("l_orderkey").cast("string"))
    t.lineitem.select(F.concat(number, F.lit("| k"), "l_suppkey", F.lit(" "), tail)).write.text(folder)
    lines = reference.base.read_lines(t.spark, folder)
    return reference.node_pairs(lines).groupBy("callsign", "node").agg(F.count(F.lit(1)).alias("n"))


@query("activity_files", """
SELECT 'K' || user_id AS callsign, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1, 2""")
def activity_files(t: Tables) -> DataFrame:
    """Activity list: further fields are tolerated, bad dates are skipped."""
    folder = scratch(t.spark)
    day = F.when(F.col("event_type") == "error", "2024-02-31").otherwise(iso_day("ts"))
    t.events.select(F.concat_ws(",", F.concat(F.lit("k"), "user_id"), day, "event_type", F.lit("x"))).write.text(folder)
    return reference.read_activity(t.spark, folder).groupBy("callsign", "day").agg(F.count(F.lit(1)).alias("n"))


@query("entity_numbers", """
SELECT 'P' || p_partkey AS "primary", (p_size + 1)::BIGINT AS number FROM part WHERE p_partkey % 9 <> 0""")
def entity_numbers(t: Tables) -> DataFrame:
    """Entity numbers: the last row of a prefix wins, bad rows are skipped."""
    folder, k = scratch(t.spark), F.col("p_partkey")
    names = F.concat(F.lit("p"), k)
    rows = t.part.select(F.explode(F.array(
        F.struct(names.alias("a"), F.lit('x, "y"').alias("b"), F.col("p_size").cast("string").alias("c")),
        F.struct(names.alias("a"), F.lit("z").alias("b"), F.when(k % 9 == 0, "no").otherwise((F.col("p_size") + 1).cast("string")).alias("c")),
    )).alias("r")).select("r.*")
    bad = t.part.filter(k % 9 == 0).select(F.lit(None).cast("string").alias("a"), F.lit("q").alias("b"), F.lit("1").alias("c"))
    good = rows.join(t.part.filter(k % 9 != 0).select(names.alias("a")), "a", "left_semi")
    good.repartition("a").sortWithinPartitions("a", F.desc("b")).unionByName(bad).sortWithinPartitions("a", "b").write.options(escape='"').csv(folder)
    return reference.read_entity_numbers(t.spark, folder)


@query("centroid_files", """
SELECT 'CANADA' AS country, 'K' || c_custkey AS postal_code, c_nationkey / 4.0::DOUBLE AS lat, c_custkey / 8.0::DOUBLE AS lon FROM customer""")
def centroid_files(t: Tables) -> DataFrame:
    """Centroid tables with keys in mixed case."""
    folder = scratch(t.spark)
    item = F.struct(F.lit(" Canada").alias("country"), F.concat(F.lit("k"), "c_custkey", F.lit(" ")).alias("postal_code"),
                    (F.col("c_nationkey") / 4).alias("lat"), (F.col("c_custkey") / 8).alias("lon"))
    # The even keys as arrays of one object a line, the odd ones as an object over several lines.
    rows = t.customer.select(F.col("c_custkey").cast("double").alias("k"), F.concat(F.to_json(item), F.lit(",")).alias("value"))
    tails = rows.select(F.floor(F.col("k") / ROWS_A_FILE).alias("p")).distinct().select(((F.col("p") + 1) * ROWS_A_FILE - 0.5).alias("k"), F.lit("{}]").alias("value"))
    for half, text in ((0, F.col("value")), (1, F.regexp_replace("value", ",", ",\n"))):
        part = rows.filter(F.col("k") % 2 == half).withColumn("value", text)
        lines_with_heads(part.unionByName(tails), f"{folder}/{half}", "[")
    return reference.read_postal_centroids(t.spark, f"{folder}/*/part=*").filter("postal_code is not null")


# --- sinks -----------------------------------------------------------------------------------------


@query("current_sink", f"""WITH {state_sql("s", "2002-06-01")}
SELECT callsign, last_name, city, license_class, dxcc::BIGINT AS dxcc, source, false AS uses_lotw, 0 AS nodes FROM s""")
def current_sink(t: Tables) -> DataFrame:
    """Current records written in the fixed schema and read back."""
    path = scratch(t.spark)
    sinks.write_current(customer_state(t, "2002-06-01"), path)
    return t.spark.read.schema(RECORD).parquet(path).select(
        "callsign", "last_name", "city", "license_class", "dxcc", "source", "uses_lotw", F.size("allstar_nodes").alias("nodes"))


@query("stored_lookup", f"""WITH {state_sql("s", "2002-06-01")}
SELECT callsign, last_name, source FROM s WHERE callsign IN ('K42', 'K777', 'K1040', 'K9', 'absent')""")
def stored_lookup(t: Tables) -> DataFrame:
    """Keys looked up in the written file: row groups and Bloom filters leave few rows to read."""
    path = scratch(t.spark)
    sinks.write_current(customer_state(t, "2002-06-01"), path)
    return t.spark.read.schema(RECORD).parquet(path).filter(F.col("callsign").isin("K42", "K777", "K1040", "K9", "absent")).select("callsign", "last_name", "source")


@query("history_sink", """
SELECT 'K' || o_custkey AS callsign, strftime(o_orderdate, '%Y-%m-%d') AS valid_from, o_orderpriority AS city, NULL::VARCHAR AS county, count(*) AS n
FROM orders GROUP BY ALL""")
def history_sink(t: Tables) -> DataFrame:
    """History rows of an older schema with a column more and one less, written and read back."""
    path = scratch(t.spark)
    rows = t.orders.select(call_of("o_custkey").alias("callsign"), iso_day("o_orderdate").alias("valid_from"), F.col("o_orderpriority").alias("city"), F.lit(1).alias("gone"))
    rows.write.parquet(f"{path}/old")
    sinks.write_history(sinks.read_history(t.spark, f"{path}/old"), f"{path}/new")
    return t.spark.read.schema(HISTORY).parquet(f"{path}/new").groupBy("callsign", "valid_from", "city", "county").agg(F.count(F.lit(1)).alias("n"))


@query("ledger_drift", """
SELECT c_custkey AS id, 'K' || c_custkey AS callsign, c_name AS last_name, false AS uses_lotw, NULL::VARCHAR AS grid FROM customer""")
def ledger_drift(t: Tables) -> DataFrame:
    """Prior ledger with missing columns at their defaults and unknown ones ignored."""
    path = scratch(t.spark)
    sinks.write_ledger(t.customer.select(F.col("c_custkey").alias("id"), call_of("c_custkey").alias("callsign"), F.col("c_name").alias("last_name"), "c_acctbal"), path)
    return sinks.read_ledger(t.spark, path, RECORD).select("id", "callsign", "last_name", "uses_lotw", "grid")


@query("talkgroup_sink", """
SELECT 'net-' || s_nationkey AS system, s_suppkey AS tg, s_name AS name FROM supplier""")
def talkgroup_sink(t: Tables) -> DataFrame:
    """Talkgroups written sorted and read back."""
    path = scratch(t.spark)
    sinks.write_talkgroups(t.supplier.select(F.concat(F.lit("net-"), "s_nationkey").alias("system"), F.col("s_suppkey").alias("tg"), F.col("s_name").alias("name")), path)
    return t.spark.read.schema(TALKGROUP).parquet(path).select("system", "tg", "name")


@query("newest_artifact", """
SELECT c_custkey AS k, 'b' AS day FROM customer""")
def newest_artifact(t: Tables) -> DataFrame:
    """The newest of several dated folders is read, by name."""
    path = scratch(t.spark)
    for day in ("2026-01-01", "2026-01-31", "2025-12-31"):
        t.customer.select(F.col("c_custkey").alias("k"), F.lit("b" if day == "2026-01-31" else "a").alias("day")).write.parquet(f"{path}/db-{day}")
    return t.spark.read.parquet(sinks.latest_artifact(t.spark, f"{path}/db-*"))


@query("flat_lists", """
SELECT l_orderkey AS k, array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS nodes FROM lineitem GROUP BY 1""")
def flat_lists(t: Tables) -> DataFrame:
    """List columns as comma strings for flat consumers."""
    lists = stored(t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.sort_array(F.collect_set("l_suppkey")).cast("array<string>").alias("nodes")))
    return sinks.flatten_lists(lists, ["nodes"])


# --- directory XML, repairs, build report ------------------------------------------------------------


@query("registry_xml", """
SELECT 'XLX' || to_base(p_partkey, 36, 3) AS id, 'h' || p_size AS host, 'R & B <' || p_brand AS description, CASE WHEN p_partkey % 3 = 0 THEN 'AT&T <x' END AS country,
  CASE WHEN length(to_base(p_partkey, 36, 3)) = 3 THEN 'XRF' || to_base(p_partkey, 36, 3) END AS callsign
FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0""")
def registry_xml(t: Tables) -> DataFrame:
    """Registry XML with bare ampersands and brackets; stale rows and rows without an address go."""
    folder, k, now = scratch(t.spark), F.col("p_partkey"), 1_760_000_000
    suffix = F.conv(k.cast("string"), 10, 36)
    name = F.concat(F.lit("XLX"), F.when(F.length(suffix) < 3, F.lpad(suffix, 3, "0")).otherwise(suffix))
    last = F.when(k % 7 == 0, now - 31 * 86400).when(k % 2 == 0, now - 29 * 86400)
    element = F.concat(
        F.lit("<reflector>\n<name>"), name, F.lit("</name><lastip>"), F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("h"), "p_size")), F.lit("</lastip><lastcontact>"),
        F.coalesce(last.cast("string"), F.lit("")), F.lit("</lastcontact>\n<country>"), F.when(k % 3 == 0, "AT&T &lt;x").otherwise(""), F.lit("</country><comment>R & B <"), "p_brand", F.lit("</comment></reflector>"))
    # The comment's bracket opens no tag: a space follows it.
    t.part.select(F.regexp_replace(element, "B <", "B < ").alias("value")).write.text(folder)
    out = directory.read_registry(t.spark, folder, now)
    return out.select("id", "host", F.regexp_replace("description", "< ", "<").alias("description"), "country", "callsign")


@query("control_repair", """
SELECT c_custkey, 'Mü' || c_name || 'x' AS name FROM customer""")
def control_repair(t: Tables) -> DataFrame:
    """A leaked code-page byte is restored, other control characters go."""
    return t.customer.select("c_custkey", repair_controls(F.concat(F.lit("M\x81\x00"), "c_name", F.lit("\x9f\x07x"))).alias("name"))


@query("callsign_shapes", """
WITH c AS (SELECT p_partkey AS k, p_size % 10 AS d FROM part), s AS (SELECT k, unnest([
  {'source': 'bnetza', 'call': 'DA' || d || 'AB'}, {'source': 'anatel', 'call': 'PY' || d || 'ABC'}, {'source': 'nkom', 'call': 'LA' || d || 'AB'}, {'source': 'enacom', 'call': 'LU' || d || 'AB'},
  {'source': 'ursec', 'call': 'CX' || d || 'AB'}, {'source': 'nmhh', 'call': 'HA' || d || 'AB'}, {'source': 'uke', 'call': 'SP' || d || 'AB'}]) AS x FROM c)
SELECT x.source AS source, count(*) AS n, count(*) FILTER (WHERE k % 3 <> 0) AS accepted FROM s GROUP BY 1""")
def callsign_shapes(t: Tables) -> DataFrame:
    """Accepted callsigns of each register's national shape; every third key has one of another country's."""
    k, d = F.col("p_partkey"), F.col("p_size") % 10
    starts = {"bnetza": "DA", "anatel": "PY", "nkom": "LA", "enacom": "LU", "ursec": "CX", "nmhh": "HA", "uke": "SP"}
    tails = {"anatel": "ABC"}
    parts = [t.part.select(F.lit(tag).alias("source"), F.concat(F.when(k % 3 == 0, "QQ").otherwise(start), d, F.lit(tails.get(tag, "AB"))).rlike(CALLSIGN_SHAPES[tag]).alias("ok")) for tag, start in starts.items()]
    return union_all(parts).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("accepted"))


@query("build_report", """
SELECT 'fcc' AS source, 'ok' AS status, '' AS reason, (SELECT count(*) FROM customer) AS n
UNION ALL SELECT 'ised', 'skipped', 'ised: missing column(s) call', NULL UNION ALL SELECT 'nmhh', 'refused', 'restricted', NULL""")
def build_report(t: Tables) -> DataFrame:
    """Sources of a partial build: one read, one skipped for a missing column, one that needs the opt-in; the report is written and read."""
    path, (fcc, *_) = scratch(t.spark), registers_of(t)
    streams, report = collect_streams({"fcc": lambda: fcc, "ised": lambda: require_columns(t.supplier, ["call"], "ised"), "nmhh": lambda: fcc})
    sinks.write_build_report(t.spark, report, path)
    rows = union_all(list(streams.values())).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return t.spark.read.schema("source string, status string, reason string").json(path).join(rows, "source", "left")
