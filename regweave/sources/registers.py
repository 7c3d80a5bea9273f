"""Ten national registers mapped to one record schema.

Column names, positions and codes below are the publishers' file layouts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regweave.functions.address import echoes_street, without_echo
from regweave.functions.dates import dotted_date, slash_date, spanish_month_date, us_date_or_same
from regweave.functions.grid import grid4
from regweave.functions.labels import (
    APPLICANT_TYPE, CALLSIGN_SHAPES, CATEGORY_PL, CLIENT_TYPE, HOLDER_TYPE_NO, ID_TYPE_BR, OPERATOR_CLASS,
    PROVINCE_AR, RECIPROCAL_SHAPE, code_label, flag_labels, is_natural_person, postal_area,
)
from regweave.functions.numbers import to_double
from regweave.functions.text import (
    decode_numeric_entities, fold_text, split_eastern_name, split_western_name, squeeze, strip, town_only,
    wordless_to_null,
)
from regweave.operators.assemble import LISTS, callbook_entries
from regweave.operators.dedupe import first_per_key, last_per_key, latest_expiry, one_holder, top_per_key, union_all
from regweave.operators.guards import GateError
from regweave.sources import base, delimited
from regweave.sources.base import Register, cell, records
from regweave.sources.spreadsheet import by_titles, spreadsheet_rows

# --- fixed values: file layouts ------------------------------------------------------
# United States, pipe files, zero-based positions.
US_HEADER = {"usi": 1, "callsign": 4, "status": 5, "grant": 7, "expired": 8, "effective": 42}
US_ENTITY = {"usi": 1, "callsign": 4, "entity_type": 5, "first": 8, "last": 10, "street": 15, "city": 16, "state": 17,
             "zip": 18, "frn": 22, "applicant": 23}
US_CLASS = {"usi": 1, "callsign": 4, "class": 5, "previous": 15}
# Australia, CSV set, default positions when a file has no header row.
AU_TOKENS = {"client_no", "licence_no", "sdd_id", "type_id"}
AU_LICENCE = {"LICENCE_NO": 0, "CLIENT_NO": 1, "LICENCE_TYPE_NAME": 4, "LICENCE_CATEGORY_NAME": 5, "DATE_ISSUED": 6,
              "DATE_OF_EFFECT": 7, "DATE_OF_EXPIRY": 8, "STATUS_TEXT": 10}
AU_CLIENT = {"CLIENT_NO": 0, "LICENCEE": 1, "POSTAL_STREET": 5, "POSTAL_SUBURB": 6, "POSTAL_STATE": 7,
             "POSTAL_POSTCODE": 8, "CLIENT_TYPE_ID": 10}
AU_DEVICE = {"LICENCE_NO": 1, "CALL_SIGN": 33}
AU_TYPE = {"TYPE_ID": 0, "NAME": 1}
# Canada, fixed width: one-based start and length.
CA_FIELDS = {"callsign": (1, 6), "given": (8, 35), "surname": (44, 35), "street": (80, 70), "city": (151, 35),
             "province": (187, 2), "postal": (190, 10), "club": (211, 70), "club_street": (353, 70),
             "club_city": (424, 35), "club_province": (460, 2), "club_postal": (463, 7)}
CA_FLAGS = [((201, 1), "Basic"), ((209, 1), "Basic with Honours"), ((203, 1), "Morse (5 wpm)"),
            ((205, 1), "Morse (12 wpm)"), ((207, 1), "Advanced")]
CA_MIN_LENGTH = 209
CA_ROW = r"^(?=[A-Z0-9]*[0-9])(?=.{6} )[A-Z0-9]{3,6} *(?<=^.{6}) "
CA_NOISE = r"(?i)^(?:\d{4}-\d{2}-\d{2}\s+Canadian Amateur Call Sign List.*|There are \d+ call signs in this report.*)|^\s*EOF\s*$"
# Brazil.
BR_COLUMNS = ["Tipo de Identificação", "Nome da Entidade", "Indicativo", "UF da Entidade", "COER", "Tipo de Estação",
              "Município da Estação", "UF da Estação", "Data do Primeiro Licenciamento",
              "Data do Último Licenciamento", "Data de Validade da Estação"]
BR_PLACEHOLDERS = ("N/I", "N/A")
# Norway.
NO_COLUMNS = ["Kallesignal", "Organisasjon", "Fornavn", "Etternavn", "Adresse", "Adresse_2", "Postnr", "Poststed", "Land",
              "Type", "Utløpsdato"]
NO_HOME = ("", "norge", "norger", "noreg", "norway")
# Poland: export file and the holder type of its rows, in order.
PL_LISTS = {"individuals.csv": "Individual", "clubs.csv": "Club", "individual_devices.csv": "Unattended station",
            "club_devices.csv": "Unattended station"}
PL_REQUIRED = ["valid_to", "call_sign", "category"]
PL_OPTIONAL = ["station_location", "station_city", "enduser_name", "applicant_name", "lat", "lng",
               "applicant_street", "applicant_house", "applicant_number", "enduser_street", "enduser_house",
               "enduser_number", "station_street", "station_house", "station_number"]
# Argentina: page file and holder type; header cells after folding.
AR_PAGES = {"todos.html": "Individual", "instituciones.html": "Organization"}
AR_HEADERS = {"radioaficionado": "name", "institucion": "name", "categoria": "class", "senal distintiva": "callsign",
              "ciudad": "city", "provincia": "province"}
# Uruguay.
UY_HEADERS = {"distintivo de llamada": "callsign", "permiso": "permit", "apellidos/razon social": "surnames",
              "nombres": "given", "categoria actual": "class", "fecha vencimiento": "expiry"}
# Start of the line above the header of the list.
UY_TITLE = "Radioaficionados"
# Hungary: header text to look for in a column title.
HU_HEADERS = {"callsign": "call sign", "name": "name of licensee", "city": "city", "street": "utca",
              "validity": "validity", "class": "eng.kat", "morse": "morse", "responsible": "felelős kezelő",
              "status": "státusz"}
HU_ACTIVE = "Kiadott"
# Germany: postcode segments of an address.
DE_POSTCODE = r"^(\d{5}) (.+)$"
DE_POSTCODE_4 = r"^(\d{4}) (?![A-Z]{2}\b)(.+)$"
DE_FOREIGN = (r"^(?:\d{4} ?[A-Z]{2} |\d{2,5}[- ]\d{2,4} |\d{6,7} |[A-Z]{2} \d{5}\b"
              r"|(?:[A-Z]{2} )?[A-Z]\d[A-Z] \d[A-Z]\d )")
# -------------------------------------------------------------------------------------


def _pick(layout: dict[str, int], rows: DataFrame) -> DataFrame:
    return rows.select(*[cell(i).alias(n) for n, i in layout.items()], "_ord")


# --- United States ---------------------------------------------------------------------


def us_records(header: DataFrame, entity: DataFrame, classes: DataFrame, synced_at: str | None = None,
               active_only: bool = True) -> DataFrame:
    """Entity rows joined to their header (inner) and class (left) on the system id.

    Header and class keep the last row per id.  Filters run below the joins.
    """
    keyed = header.filter("usi is not null")
    head = last_per_key(keyed.drop("callsign"), ["usi"], F.col("_ord"), drop=("_ord",))
    if active_only:
        head = head.filter("status = 'A'")
    klass = last_per_key(
        classes.filter("usi is not null").select("usi", F.col("class").alias("_class"), "previous", "_ord"),
        ["usi"], F.col("_ord"), drop=("_ord",),
    )
    rows = entity.filter("usi is not null and callsign is not null").join(head, "usi").join(klass, "usi", "left")
    street = [F.col("street")]
    return records(
        rows, "fcc", synced_at, callsign=F.col("callsign"), first_name=without_echo(F.col("first"), street),
        last_name=without_echo(F.col("last"), street), city=without_echo(F.col("city"), street),
        state=F.col("state"), postal_code=F.col("zip"), license_class=code_label(F.col("_class"), OPERATOR_CLASS),
        grant_date=us_date_or_same(F.col("grant")), effective_date=us_date_or_same(F.col("effective")),
        expired_date=us_date_or_same(F.col("expired")), frn=F.col("frn"), entity_type=F.col("entity_type"),
        applicant_type=code_label(F.col("applicant"), APPLICANT_TYPE), previous_callsign=F.col("previous"),
    )


def read_us(spark: SparkSession, path: str, synced_at: str | None = None, active_only: bool = True) -> DataFrame:
    """Directory with HD.dat, EN.dat and AM.dat."""
    parts = [
        _pick(layout, base.split_delimited(base.read_lines(spark, f"{path}/{name}", "ISO-8859-1"), "|"))
        for name, layout in (("HD.dat", US_HEADER), ("EN.dat", US_ENTITY), ("AM.dat", US_CLASS))
    ]
    return us_records(*parts, synced_at=synced_at, active_only=active_only)


# --- Australia ---------------------------------------------------------------------------


def au_records(device: DataFrame, licence: DataFrame, client: DataFrame, types: DataFrame | None,
               synced_at: str | None = None, granted_only: bool = True) -> DataFrame:
    """Device rows joined to amateur licences, their clients and the client type names."""
    lic = licence.filter(F.lower("LICENCE_TYPE_NAME").contains("amateur") & F.col("LICENCE_NO").isNotNull())
    if granted_only:
        lic = lic.filter(F.lower("STATUS_TEXT") == "granted")
    lic = last_per_key(lic, ["LICENCE_NO"], F.col("_ord"), drop=("_ord",))
    # Only clients of kept licences are shuffled.
    wanted = client.filter("CLIENT_NO is not null").join(lic.select("CLIENT_NO"), "CLIENT_NO", "left_semi")
    cli = last_per_key(wanted, ["CLIENT_NO"], F.col("_ord"), drop=("_ord",))
    dev = device.filter("LICENCE_NO is not null and CALL_SIGN is not null").withColumn("CALL_SIGN", F.upper("CALL_SIGN"))
    dev = first_per_key(dev.join(lic.select("LICENCE_NO"), "LICENCE_NO", "left_semi"), ["CALL_SIGN"], F.col("_ord"))
    rows = dev.withColumnRenamed("_ord", "_o").join(lic, "LICENCE_NO").join(cli, "CLIENT_NO", "left").withColumnRenamed("_o", "_ord")
    kind = F.col("CLIENT_TYPE_ID")
    label = F.try_element_at(F.create_map(*[F.lit(x) for p in CLIENT_TYPE.items() for x in p]), kind)
    if types is not None:
        names = last_per_key(types.filter("TYPE_ID is not null and NAME is not null"), ["TYPE_ID"], F.col("_ord"), drop=("_ord",))
        rows = rows.join(names.select(F.col("TYPE_ID").alias("_t"), F.col("NAME").alias("_type_name")), kind == F.col("_t"), "left")
        label = F.coalesce("_type_name", label)
    public = F.col("CLIENT_TYPE_ID").isNotNull() & ~is_natural_person(kind, F.col("LICENCEE"))
    street = [F.col("POSTAL_STREET")]
    return records(
        rows, "acma", synced_at, callsign=F.col("CALL_SIGN"),
        last_name=F.when(public, without_echo(squeeze(F.col("LICENCEE")), street)),
        city=F.when(public, without_echo(F.col("POSTAL_SUBURB"), street)),
        state=F.when(public, F.col("POSTAL_STATE")), postal_code=F.when(public, F.col("POSTAL_POSTCODE")),
        license_class=F.col("LICENCE_CATEGORY_NAME"), grant_date=F.col("DATE_ISSUED"),
        effective_date=F.col("DATE_OF_EFFECT"), expired_date=F.col("DATE_OF_EXPIRY"), applicant_type=label,
    )


def _au_file(spark: SparkSession, path: str, layout: dict[str, int]) -> DataFrame:
    return delimited.table(spark, path, layout, encoding="ISO-8859-1", header_tokens=AU_TOKENS)


def read_au(spark: SparkSession, path: str, synced_at: str | None = None, granted_only: bool = True,
            has_types: bool = True) -> DataFrame:
    """Directory with device_details.csv, licence.csv, client.csv and client_type.csv."""
    return au_records(
        _au_file(spark, f"{path}/device_details.csv", AU_DEVICE), _au_file(spark, f"{path}/licence.csv", AU_LICENCE),
        _au_file(spark, f"{path}/client.csv", AU_CLIENT),
        _au_file(spark, f"{path}/client_type.csv", AU_TYPE) if has_types else None, synced_at, granted_only,
    )


# --- Canada --------------------------------------------------------------------------------


def _fixed(name_or_span) -> Column:
    start, length = CA_FIELDS[name_or_span] if isinstance(name_or_span, str) else name_or_span
    return F.substring("value", start, length)


def ca_records(lines: DataFrame, synced_at: str | None = None) -> DataFrame:
    """Fixed-width rows.  A line that is neither a row nor a report line is an error that
    fails the job when it is read."""
    is_row = F.col("value").rlike(CA_ROW) & (F.length("value") >= CA_MIN_LENGTH)
    body = lines.filter((strip(F.col("value")) != "") & ~F.col("value").rlike(CA_NOISE))
    checked = body.withColumn(
        "value",
        F.when(is_row, F.col("value")).otherwise(
            F.raise_error(F.concat(F.lit("not a fixed-width call sign row: "), F.substring("value", 1, 40))).cast("string")
        ),
    )

    def field(name: str) -> Column:
        return wordless_to_null(strip(decode_numeric_entities(_fixed(name))))

    club = field("club")
    is_club = club.isNotNull()
    streets = [field("street"), field("club_street")]

    def holder(person: str, organisation: str) -> Column:
        return F.when(is_club, field(organisation)).otherwise(field(person))

    return records(
        checked, "ised", synced_at, callsign=strip(_fixed("callsign")),
        first_name=without_echo(F.when(~is_club, field("given")), streets),
        last_name=without_echo(F.when(is_club, club).otherwise(field("surname")), streets),
        city=without_echo(holder("city", "club_city"), streets), state=holder("province", "club_province"),
        postal_code=postal_area(holder("postal", "club_postal")),
        license_class=flag_labels([(strip(_fixed(span)) != "", label) for span, label in CA_FLAGS]),
    )


def read_ca(spark: SparkSession, path: str, synced_at: str | None = None) -> DataFrame:
    """Fixed-width report, UTF-8 or ISO-8859-1."""
    return ca_records(base.read_lines_guessing(spark, path, "latin-1"), synced_at)


# --- Brazil --------------------------------------------------------------------------------


def br_records(rows: DataFrame, synced_at: str | None = None) -> DataFrame:
    """Station rows to one record per callsign."""

    def value(name: str) -> Column:
        text = squeeze(F.col(f"`{name}`"))
        return F.when(~text.isin(*BR_PLACEHOLDERS), text)

    flat = rows.select(
        F.upper(strip(F.col("Indicativo"))).alias("callsign"), value("Nome da Entidade").alias("name"),
        value("Tipo de Identificação").alias("id_type"), value("COER").alias("class"),
        value("UF da Entidade").alias("entity_state"), value("Município da Estação").alias("town"),
        value("UF da Estação").alias("town_state"), value("Tipo de Estação").alias("station_type"),
        slash_date(value("Data do Primeiro Licenciamento")).alias("first"),
        slash_date(value("Data do Último Licenciamento")).alias("last"),
        slash_date(value("Data de Validade da Estação")).alias("valid"), "_ord",
    ).filter(F.col("callsign").rlike(CALLSIGN_SHAPES["anatel"]))
    holders = one_holder(
        flat, "callsign", F.col("_ord"), ["name", "id_type", "class", "entity_state"],
        {"grant": "first", "row": "_ord"}, {"effective": "last", "expired": "valid"}, ("town", "town_state"),
        F.col("station_type") == "Fixa", fallback_state="entity_state",
    ).withColumnRenamed("row", "_ord")
    return records(
        holders, "anatel", synced_at, callsign=F.col("callsign"), last_name=F.col("name"), city=F.col("city"),
        state=F.col("state"), license_class=F.col("class"), grant_date=F.col("grant"),
        effective_date=F.col("effective"), expired_date=F.col("expired"),
        applicant_type=F.try_element_at(F.create_map(*[F.lit(x) for p in ID_TYPE_BR.items() for x in p]), F.col("id_type")),
    )


def read_br(spark: SparkSession, path: str, synced_at: str | None = None) -> DataFrame:
    """Semicolon CSV with a byte-order mark."""
    return br_records(delimited.table(spark, path, dict.fromkeys(BR_COLUMNS), ";", required=BR_COLUMNS), synced_at)


# --- Norway --------------------------------------------------------------------------------


def no_records(rows: DataFrame, synced_at: str | None = None) -> DataFrame:
    """Organisation replaces the person; foreign towns and odd postcodes are withheld."""

    def value(name: str) -> Column:
        return squeeze(F.col(f"`{name}`"))

    organisation = value("Organisasjon")
    home = F.lower(F.coalesce(value("Land"), F.lit(""))).isin(*NO_HOME)
    streets = [value("Adresse"), value("Adresse_2")]
    kind = value("Type")
    shaped = rows.withColumn("_call", F.upper(strip(F.col("Kallesignal")))).filter(
        F.col("_call").rlike(CALLSIGN_SHAPES["nkom"])
    )
    out = records(
        shaped, "nkom", synced_at, callsign=F.col("_call"),
        first_name=without_echo(F.when(organisation.isNull(), value("Fornavn")), streets),
        last_name=without_echo(F.coalesce(organisation, value("Etternavn")), streets),
        city=without_echo(F.when(home, value("Poststed")), streets),
        postal_code=F.when(home & value("Postnr").rlike(r"^\d{4}$"), value("Postnr")),
        expired_date=dotted_date(value("Utløpsdato")), applicant_type=code_label(kind, HOLDER_TYPE_NO, F.lower(kind)),
    )
    return first_per_key(out, ["callsign"], F.col("_ord"))


def read_no(spark: SparkSession, path: str, synced_at: str | None = None) -> DataFrame:
    """Semicolon CSV without quoting; the code page of each file follows from the bytes of its header."""
    lines = base.read_lines(spark, path, "ISO-8859-1")
    utf8 = "ø".encode().decode("latin-1")
    pages: dict[str, list[str]] = {}
    for name, found in delimited.profile(spark, path).items():
        head = found.first
        pages.setdefault("UTF-8" if utf8 in head else "cp1252" if "\xf8" in head else "cp865", []).append(name)
    text = F.encode("value", "ISO-8859-1").cast("string")
    for codec in pages.keys() - {"UTF-8"}:
        text = F.when(F.col("_ord.path").isin(pages[codec]), base.byte_translate(F.col("value"), codec)).otherwise(text)
    lines = lines.withColumn("value", text)
    rows = base.split_delimited(lines, ";")
    return no_records(base.by_header(rows, dict.fromkeys(NO_COLUMNS), required=NO_COLUMNS), synced_at)


# --- Poland --------------------------------------------------------------------------------


def pl_records(rows: DataFrame, synced_at: str | None = None) -> DataFrame:
    """Union of the exports (``holder_type``, ``list_no``), latest expiry per callsign."""
    raw_town = F.coalesce("station_location", "station_city")
    town = town_only(raw_town)
    streets = []
    for party in ("applicant", "enduser", "station"):
        street, house, flat = (F.col(f"{party}_{x}") for x in ("street", "house", "number"))
        full = F.trim(F.concat(street, F.lit(" "), F.coalesce(house, F.lit("")),
                               F.coalesce(F.concat(F.lit("/"), flat), F.lit(""))))
        streets.append(F.when(~(F.lower(street) == F.lower(town)) | town.isNull(), full))
    lat, lon = to_double(F.col("lat"), True), to_double(F.col("lng"), True)
    located = lat.between(-90, 90) & lon.between(-180, 180) & ~((lat == 0) & (lon == 0))
    shaped = rows.withColumn("call_sign", F.upper("call_sign")).filter(F.col("call_sign").rlike(CALLSIGN_SHAPES["uke"]))
    out = records(
        shaped, "uke", synced_at, callsign=F.col("call_sign"),
        last_name=without_echo(F.coalesce("enduser_name", "applicant_name"), streets), city=without_echo(town, streets),
        grid=F.when(located, grid4(lat, lon)), license_class=code_label(F.col("category"), CATEGORY_PL),
        expired_date=F.col("valid_to"), applicant_type=F.col("holder_type"),
    )
    return latest_expiry(out, ["callsign"], "expired_date", F.col("_ord"))


def read_pl(spark: SparkSession, path: str, synced_at: str | None = None) -> DataFrame:
    """Directory with the four exports; UTF-8, else cp1250."""
    parts = []
    columns = dict.fromkeys(PL_REQUIRED + PL_OPTIONAL)
    for number, (name, kind) in enumerate(PL_LISTS.items()):
        named = delimited.table(spark, f"{path}/{name}", columns, ";", fallback="cp1250", required=PL_REQUIRED)
        # List order comes first in the row order.
        order = F.struct(F.lit(f"{number}").alias("path"), F.col("_ord.block").alias("block"), F.col("_ord.row").alias("row"))
        parts.append(named.withColumn("_ord", order).withColumn("holder_type", F.lit(kind)))
    return pl_records(union_all(parts), synced_at)


# --- Argentina -----------------------------------------------------------------------------


def html_rows(pages: DataFrame, key: str, html: str, table_class: str | None = None) -> DataFrame:
    """``(key, row_no, headers, cells)`` for each table row of an HTML text column."""
    body = F.col(html)
    if table_class:
        body = F.regexp_extract(
            body, rf'(?is)<table\b[^>]*class\s*=\s*["\'](?:[^"\']*\s)?{table_class}(?:\s[^"\']*)?["\'][^>]*>(.*?)</table>', 1
        )
    rows = F.regexp_extract_all(body, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))

    def cells(tag: str) -> Column:
        found = F.regexp_extract_all("_row", F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
        return F.transform(found, lambda c: F.coalesce(squeeze(html_text(c)), F.lit("")))

    return (
        pages.select(key, F.posexplode(rows).alias("row_no", "_row"))
        .select(key, "row_no", cells("th").alias("headers"), cells("td").alias("cells"))
    )


def html_text(col: Column) -> Column:
    """Text of an HTML fragment: tags dropped, common references decoded."""
    text = F.regexp_replace(col, r"(?s)<[^>]*>", "")
    text = decode_numeric_entities(text)
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def ar_records(rows: DataFrame, columns: dict[str, int], holder_type: str, synced_at: str | None = None) -> DataFrame:
    """Cells of one listing to records (duplicates kept, shape rejects dropped)."""
    text = {n: F.nullif(F.try_element_at("cells", F.lit(i + 1)), F.lit("")) for n, i in columns.items()}
    shaped = rows.withColumn("_call", F.upper(text["callsign"])).filter(F.col("_call").rlike(CALLSIGN_SHAPES["enacom"]))
    klass = text["class"]
    return records(
        shaped, "enacom", synced_at, callsign=F.col("_call"), last_name=text["name"], city=text["city"],
        state=code_label(text["province"], PROVINCE_AR),
        license_class=F.concat(F.upper(F.substring(klass, 1, 1)), F.lower(klass.substr(F.lit(2), F.length(klass)))),
        applicant_type=F.lit(holder_type),
    )


def read_ar(spark: SparkSession, path: str, synced_at: str | None = None) -> DataFrame:
    """Directory with the two listing pages, split at row ends so that no task holds a page.

    The declared row count must equal the number of rows found.
    """
    parts = []
    for number, (name, kind) in enumerate(AR_PAGES.items()):
        chunks = base.read_lines(spark, f"{path}/{name}", line_sep="</tr>")
        table = r'(?i)<table\b[^>]*class\s*=\s*["\'](?:[^"\']*\s)?listado(?:\s[^"\']*)?["\']'
        bounds = chunks.agg(
            F.min(F.when(F.col("value").rlike(table), F.col("_ord"))).alias("first"),
            F.min(F.when(F.col("value").rlike(r"(?i)</table>") & ~F.col("value").rlike(table), F.col("_ord"))).alias("any_end"),
            F.max(F.regexp_extract("value", r"Registros encontrados:\s*(\d+)", 1)).alias("declared"),
        ).first()
        if bounds["first"] is None:
            raise GateError(f"{name}: no listing table")
        inside = chunks.filter(F.col("_ord") >= _order_literal(bounds["first"]))
        ended = inside.filter(F.col("value").rlike(r"(?i)</table>") & ~F.col("value").rlike(table)).agg(F.min("_ord").alias("e")).first()["e"]
        if ended is not None:
            inside = inside.filter(F.col("_ord") < _order_literal(ended))
        row = F.regexp_extract("value", r"(?is)<tr\b[^>]*>(.*)$", 1)

        def cells(tag: str, row: Column = row) -> Column:
            found = F.regexp_extract_all(row, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
            return F.transform(found, lambda c: F.coalesce(squeeze(html_text(c)), F.lit("")))

        rows = inside.select(cells("th").alias("headers"), cells("td").alias("cells"), "_ord")
        headers = rows.filter(F.size("headers") > 0).agg(F.min_by("headers", "_ord")).first()[0]
        if not headers:
            raise GateError(f"{name}: the table has no header")
        body = rows.filter(F.size("cells") > 0)
        odd, found = body.agg(F.count_if(F.size("cells") != len(headers)), F.count(F.lit(1))).first()
        if odd or (bounds["declared"] not in (None, "") and int(bounds["declared"]) != found):
            raise GateError(f"{name}: {found} rows ({odd} uneven), page says {bounds['declared']}")
        order = F.struct(F.lit(f"{number}").alias("path"), F.col("_ord.block").alias("block"), F.col("_ord.row").alias("row"))
        parts.append(ar_records(body.withColumn("_ord", order), base.folded_positions(headers, AR_HEADERS), kind, synced_at))
    return first_per_key(union_all(parts), ["callsign"], F.col("_ord"))


def _order_literal(row) -> Column:
    return F.struct(
        F.lit(row["path"]).alias("path"), F.lit(row["block"]).cast("bigint").alias("block"),
        F.lit(row["row"]).cast("bigint").alias("row"),
    )


# --- Uruguay -------------------------------------------------------------------------------


def uy_records(rows: DataFrame, synced_at: str | None = None) -> DataFrame:
    """Sheet rows (callsign, permit, surnames, given, class, expiry, _ord).

    Visitors are dropped; a permanent permit beats a visiting one, then the later expiry,
    then the first row.
    """
    call = F.upper("callsign")
    kept = rows.withColumn("_call", call).filter(
        ~F.col("_call").rlike(RECIPROCAL_SHAPE) & F.col("_call").rlike(CALLSIGN_SHAPES["ursec"])
    )
    iso = F.when(F.col("expiry").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("expiry")).otherwise(spanish_month_date(F.col("expiry")))
    visiting = F.upper(F.coalesce("permit", F.lit(""))) == "IARP"
    klass = F.col("class")
    ranked = top_per_key(
        kept.withColumn("_iso", iso), ["_call"], [visiting.asc(), F.coalesce("_iso", F.lit("")).desc(), F.col("_ord").asc()]
    )
    return records(
        ranked, "ursec", synced_at, callsign=F.col("_call"), first_name=F.col("given"), last_name=F.col("surnames"),
        license_class=F.concat(F.upper(F.substring(klass, 1, 1)), F.lower(klass.substr(F.lit(2), F.length(klass)))),
        expired_date=F.col("_iso"),
        applicant_type=F.when(F.col("given") != "", F.lit("Individual")).otherwise(F.lit("Organization")),
    )


def read_uy(spark: SparkSession, path: str, synced_at: str | None = None) -> DataFrame:
    """Sheet rows as semicolon CSV, lines of any kind above the header left out by their start; names matched without accents and case."""
    rows = delimited.table(spark, path, dict.fromkeys(UY_HEADERS), ";", required=list(UY_HEADERS), title=UY_TITLE, key=fold_text)
    named = rows.select(*[F.col(f"`{h}`").alias(field) for h, field in UY_HEADERS.items()], "_ord").filter("callsign is not null")
    return uy_records(named, synced_at)


# --- Hungary -------------------------------------------------------------------------------


def hu_records(rows: DataFrame, synced_at: str | None = None) -> DataFrame:
    """Issued licences, one per callsign by latest validity."""
    call = F.upper(F.coalesce("callsign", F.lit("")))
    issued = rows.filter(F.col("status") == HU_ACTIVE).withColumn("_call", call).filter(
        F.col("_call").rlike(CALLSIGN_SHAPES["nmhh"])
    )
    club = F.coalesce(F.lower("responsible") != F.lower("name"), F.lit(False))
    person = split_eastern_name(F.col("name"))

    def guard(value: Column) -> Column:
        street = F.col("street")
        echo = echoes_street(value, [street]) | F.coalesce(F.lower(value) == F.lower(street), F.lit(False))
        return F.when(~echo, value)

    validity = F.col("validity")
    out = records(
        issued, "nmhh", synced_at, callsign=F.col("_call"), first_name=guard(F.when(~club, person["first"])),
        last_name=guard(F.when(club, F.col("name")).otherwise(person["last"])), city=guard(F.col("city")),
        license_class=F.nullif(F.concat_ws(", ", "class", "morse"), F.lit("")),
        expired_date=F.when(validity.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(validity, 1, 10)),
        applicant_type=F.when(club, F.lit("Club")),
    )
    return latest_expiry(out, ["callsign"], "expired_date", F.col("_ord"))


def read_hu(spark: SparkSession, path: str, synced_at: str | None = None) -> DataFrame:
    """Spreadsheet XML."""
    return hu_records(by_titles(spreadsheet_rows(spark, path), HU_HEADERS), synced_at)


# --- Germany -------------------------------------------------------------------------------


def holder_location(segments: Column) -> Column:
    """``struct(city, postal_code, found)`` from the first postcode-shaped segment."""
    def shape(s: Column) -> Column:
        return (
            F.when(s.rlike(DE_POSTCODE), F.struct(strip(F.regexp_extract(s, DE_POSTCODE, 2)).alias("city"),
                                                  F.regexp_extract(s, DE_POSTCODE, 1).alias("postal_code")))
            .when(s.rlike(DE_POSTCODE_4), F.struct(strip(F.regexp_extract(s, DE_POSTCODE_4, 2)).alias("city"),
                                                   F.lit(None).cast("string").alias("postal_code")))
            .when(s.rlike(DE_FOREIGN), F.struct(F.lit(None).cast("string").alias("city"),
                                                F.lit(None).cast("string").alias("postal_code")))
        )

    hits = F.filter(F.transform(segments, shape), lambda x: x.isNotNull())
    return F.try_element_at(hits, F.lit(1))


def de_records(entries: DataFrame, synced_at: str | None = None) -> DataFrame:
    """Accepted callbook entries (list_no, callsign, license_class, entry_text, line_no)."""
    text = squeeze(F.col("entry_text"))
    cut = F.when(text.contains(";"), F.instr(text, ";")).when(text.contains(", "), F.instr(text, ", "))
    name_part = F.when(cut.isNotNull(), F.substring(text, F.lit(1), cut - 1)).otherwise(text)
    address = F.when(cut.isNotNull(), text.substr(cut + 1, F.length(text))).otherwise(F.lit(""))
    name = strip(F.substring_index(name_part, ",", 1))
    rows = entries.filter("not rejected").withColumn("_name", split_western_name(name)).withColumn(
        "_seg", F.filter(F.transform(F.split(address, ","), strip), lambda s: s != "")
    ).withColumn("_loc", holder_location(F.col("_seg")))
    # An entry has a handful of segments; comparing against their joined text would
    # change word boundaries, so the streets are checked one by one.
    other = F.filter("_seg", lambda s: ~s.rlike(DE_POSTCODE) & ~s.rlike(DE_POSTCODE_4))

    def guard(value: Column) -> Column:
        return F.when(~F.exists(other, lambda s: echoes_street(value, [s])), value)

    kinds = F.create_map(*[F.lit(x) for p in LISTS.items() for x in p])
    order = F.struct(F.col("doc").cast("string").alias("path"), F.lit(0).cast("bigint").alias("block"), F.col("line_no").alias("row"))
    out = records(
        rows.withColumn("_ord", order), "bnetza", synced_at, callsign=F.col("callsign"), first_name=guard(F.col("_name.first")),
        last_name=guard(F.col("_name.last")), city=guard(F.col("_loc.city")), postal_code=F.col("_loc.postal_code"),
        license_class=F.col("license_class"), applicant_type=F.try_element_at(kinds, F.col("list_no")),
    )
    return first_per_key(out, ["callsign"], F.col("_ord"))


def read_de(lines: DataFrame, synced_at: str | None = None) -> DataFrame:
    """Page lines ``(doc, page, line_no, text)`` of a callbook."""
    entries, _violations = callbook_entries(lines)
    return de_records(entries, synced_at)


def page_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(doc, page, line_no, text)`` of text files whose pages end in form feeds, read page by page by many tasks.

    A page has its end at least, so split start and count of pages in the task, added, grow with the pages of a file.
    """
    pages = spark.read.option("lineSep", "\f").text(path).select("value", base.file_order())
    count = F.col("_ord.row").bitwiseAND(F.lit((1 << 33) - 1))
    lines = F.posexplode(F.split(F.regexp_replace("value", "\r", ""), "\n")).alias("line_no", "text")
    return pages.select(F.col("_ord.path").alias("doc"), (F.col("_ord.block") + count).alias("page"), lines).withColumn("line_no", F.col("line_no").cast("bigint"))


def read_de_pages(spark: SparkSession, path: str, synced_at: str | None = None) -> DataFrame:
    """Callbook as text with form feeds between its pages."""
    return read_de(page_lines(spark, path), synced_at)


REGISTERS = {
    r.tag: r
    for r in (
        Register("fcc", read_us), Register("ised", read_ca), Register("acma", read_au), Register("nkom", read_no),
        Register("anatel", read_br), Register("enacom", read_ar), Register("nmhh", read_hu), Register("uke", read_pl),
        Register("bnetza", read_de_pages), Register("ursec", read_uy),
    )
}
