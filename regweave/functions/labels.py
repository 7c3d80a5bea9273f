"""Code tables and label lists.  All tables are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regweave.functions.dates import literal_map

# --- fixed values --------------------------------------------------------------------
# Source rank, best first: resolves a key that two registers both list.
SOURCE_PRECEDENCE = ("fcc", "ised", "acma", "nkom", "bnetza", "anatel", "enacom", "ursec",
                     "nmhh", "uke")
# Sources that are only read when the caller opts in.
RESTRICTED_SOURCES = ("nmhh",)
# Whole datasets of the same kind: activity flags of the registry, summits of the park build.
RESTRICTED_DATASETS = ("activity", "summits")
# The postal system a regulator's addresses use.
POSTAL_COUNTRY = {"fcc": "United States", "ised": "Canada", "acma": "Australia"}

OPERATOR_CLASS = {"E": "Amateur Extra", "A": "Advanced", "G": "General", "T": "Technician",
                  "P": "Technician Plus", "N": "Novice"}
APPLICANT_TYPE = {"I": "Individual", "B": "Amateur Club", "M": "Military Recreation",
                  "R": "RACES", "C": "Corporation", "G": "Governmental Entity",
                  "E": "Limited Liability Company", "J": "Joint Venture",
                  "L": "Limited Liability Corporation", "O": "Consortium", "P": "Partnership",
                  "T": "Trust", "U": "Unincorporated Association"}
CLIENT_TYPE = {"1": "Commonwealth Department", "2": "Other Commonwealth Agency",
               "3": "State Government", "4": "Local Government", "5": "Company",
               "6": "Community or Volunteer Group", "7": "Person"}
HOLDER_TYPE_NO = {"personlig": "Person", "organisasjon": "Organisation", "skole": "School",
                  "bedrift": "Company", "myndighet": "Government", "forsvar": "Military"}
CATEGORY_PL = {"Kategoria1": "Category 1", "Kategoria3": "Category 3",
               "Kategoria5": "Category 5", "Dodatkowe": "Additional"}
ID_TYPE_BR = {"CPF": "Individual", "CNPJ": "Organization"}
PROVINCE_AR = {
    "CIUDAD DE BUENOS AIRES": "Ciudad Autónoma de Buenos Aires",
    "PROVINCIA DE BUENOS AIRES": "Buenos Aires",
    "CATAMARCA": "Catamarca", "CHACO": "Chaco", "CHUBUT": "Chubut", "CÓRDOBA": "Córdoba",
    "CORRIENTES": "Corrientes", "ENTRE RÍOS": "Entre Ríos", "FORMOSA": "Formosa",
    "JUJUY": "Jujuy", "LA PAMPA": "La Pampa", "LA RIOJA": "La Rioja", "MENDOZA": "Mendoza",
    "MISIONES": "Misiones", "NEUQUÉN": "Neuquén", "RÍO NEGRO": "Río Negro", "SALTA": "Salta",
    "SAN JUAN": "San Juan", "SAN LUIS": "San Luis", "SANTA CRUZ": "Santa Cruz",
    "SANTA FE": "Santa Fe", "SANTIAGO DEL ESTERO": "Santiago del Estero",
    "TIERRA DEL FUEGO A. E I.A.S.": "Tierra del Fuego", "TUCUMÁN": "Tucumán",
}
# National callsign shapes.
CALLSIGN_SHAPES = {
    "bnetza": r"^D[A-R][0-9]{1,4}(?:[A-Z0-9]{0,6}[A-Z])$",
    "anatel": r"^(?:P[P-Y]|Z[V-Z])[0-9][A-Z]{1,3}$",
    "nkom": r"^(?:L[A-N]|JW|JX|3Y)[0-9]{1,3}[A-Z]{1,4}$",
    "enacom": r"^(?:L[O-W]|A[Y-Z])[0-9][A-Z]{1,3}$",
    "ursec": r"^C[V-X][0-9][A-Z]{1,3}$",
    "nmhh": r"^H[AG][0-9]+[A-Z][A-Z0-9]*$",
    "uke": r"^(S[N-R]|3Z|HF)[0-9]+[A-Z][A-Z0-9]*$",
}
RECIPROCAL_SHAPE = r"^[A-Z0-9]{1,3}[0-9][A-Z]{1,4}/CX$"
# Directory sources and the licence of their rows; others state none.
SOURCE_LICENSE = {"dvref": "CC-BY-4.0", "xlx": "none-stated", "dextra": "none-stated"}
NONE_STATED = "none-stated"
CC_BY = "CC-BY-4.0"
# Licensee-name words that mark an organisation, and lines about a person behind one.
ORGANISATION_WORDS = (
    "club", "society", "group", "association", "assoc", "associates", "inc", "incorporated",
    "institute", "network", "wicen", "scouts?", "branch", "college", "company", "co", "ltd",
    "limited", "pty", "ambulance", "broadcasters", "shed", "friends", "foundation", "council",
    "committee", "federation", "league", "union", "trust", "team", "service", "services",
    "radio",
)
PERSON_LINE = r"(?iu)^\s*(?:nominee|attn|attention|c/-|c/o)\b"
ORGANISATION_TYPES = ("1", "2", "3", "4", "5")
COMMUNITY_TYPE = "6"
# -------------------------------------------------------------------------------------

_ORGANISATION = r"(?iu)(?U)\b(?:" + "|".join(ORGANISATION_WORDS) + r")\b"


def code_label(code: Column, table: dict[str, str], key: Column | None = None) -> Column:
    """Readable label of a code; unknown codes pass through."""
    return F.coalesce(F.try_element_at(literal_map(table), code if key is None else key), code)


def flag_labels(flags: list[tuple[Column, str]]) -> Column:
    """Comma-joined labels of the flags that are set, in the given order; null if none."""
    joined = F.concat_ws(", ", *[F.when(flag, F.lit(label)) for flag, label in flags])
    return F.nullif(joined, F.lit(""))


def precedence_rank(source: Column) -> Column:
    """Rank of a source, lower is better; unknown or null ranks last."""
    ranks = {name: rank for rank, name in enumerate(SOURCE_PRECEDENCE)}
    return F.coalesce(F.try_element_at(literal_map(ranks), source), F.lit(len(ranks)))


def row_license(source: Column) -> Column:
    """Licence of a directory row; an unknown source under-claims."""
    return F.coalesce(F.try_element_at(literal_map(SOURCE_LICENSE), source), F.lit(NONE_STATED))


def is_natural_person(client_type: Column, name: Column) -> Column:
    """True unless the client type (and, for community groups, the name) marks an
    organisation.  Blank or unknown types count as a person."""
    kind = F.trim(F.coalesce(client_type, F.lit("")))
    community = (kind == COMMUNITY_TYPE) & F.coalesce(name != "", F.lit(False))
    return (
        F.when(kind.isin(*ORGANISATION_TYPES), F.lit(False))
        .when(community, name.rlike(PERSON_LINE) | ~name.rlike(_ORGANISATION))
        .otherwise(F.lit(True))
    )


def postal_area(code: Column) -> Column:
    """First three characters of a letter-digit-letter postal code, else null."""
    return F.nullif(
        F.regexp_extract(F.upper(F.trim(code)), r"^[A-Z][0-9][A-Z]", 0), F.lit("")
    )


def postal_country(source: Column, country: Column) -> Column:
    """Country whose postal system the row's address uses."""
    by_source = F.try_element_at(literal_map(POSTAL_COUNTRY), source)
    return F.upper(F.trim(F.coalesce(by_source, country, F.lit(""))))


def postal_key(country: Column, code: Column) -> Column:
    """Postal code at the granularity of the centroid table."""
    compact = F.translate(F.upper(F.trim(F.coalesce(code, F.lit("")))), " -", "")
    return (
        F.when(country == "UNITED STATES", F.substring(compact, 1, 5))
        .when(country == "CANADA", F.substring(compact, 1, 3))
        .otherwise(compact)
    )


def first_subdivision(location: Column) -> Column:
    """``US-ME,US-NH`` to ``ME``; a value without a dash is kept; blank gives null."""
    first = F.btrim(F.substring_index(location, ",", 1))
    cut = F.when(
        first.contains("-"), F.btrim(F.regexp_replace(first, r"^[^-]*-", ""))
    ).otherwise(first)
    return F.nullif(cut, F.lit(""))


def bare_host(col: Column) -> Column:
    """Host name or address; null for URLs, paths and values with inner spaces."""
    host = F.nullif(F.btrim(col), F.lit(""))
    return F.when(~host.rlike(r"(?U)://|/|\s"), host)


def wire_name(name: Column) -> Column:
    """``XLX836`` to its wire form ``XRF836``; null for any other shape."""
    suffix = F.regexp_extract(F.upper(F.btrim(name)), r"^XLX([0-9A-Z]{3})$", 1)
    return F.when(suffix != "", F.concat(F.lit("XRF"), suffix))


def module_letters(values: Column) -> Column:
    """Sorted distinct single letters, upper-cased; anything else is dropped."""
    clean = F.transform(values, lambda v: F.upper(F.btrim(v)))
    kept = F.filter(clean, lambda v: v.rlike(r"^\p{L}$"))
    return F.coalesce(F.array_sort(F.array_distinct(kept)), F.array().cast("array<string>"))
