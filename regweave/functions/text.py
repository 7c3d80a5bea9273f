"""String cleaning, title case, names and towns as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------
# White space in the Unicode sense; `trim` alone leaves no-break spaces.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
PARTICLES = ("de", "del", "della", "van", "von", "der", "den", "da", "das", "dos", "di",
             "du", "la", "le", "of", "the")
ACRONYMS = ("ARRL", "ARC", "ARES", "RACES", "VFW", "EOC", "USA", "VHF", "UHF", "DX")
MAC_NAMES = ("MACDONALD", "MACARTHUR", "MACKENZIE", "MACLEOD", "MACMILLAN", "MACGREGOR",
             "MACINTOSH", "MACINTYRE", "MACNEIL", "MACPHERSON", "MACKAY", "MACLEAN",
             "MACLACHLAN")
ROMAN_SUFFIXES = ("II", "III", "IV", "V", "VI", "VII", "VIII", "IX")
ACADEMIC_TITLES = ("Dr.", "Prof.", "Dipl.", "Ing.", "Dipl.-Ing.", "Dr.-Ing.", "med.")
SURNAME_JOINERS = ("geb.", "gen.", "genannt", "und", "y")
NAME_SUFFIXES = ("jun.", "sen.", "jr.", "sr.")
HONORIFICS = ("dr", "prof", "id", "ifj", "özv")
STREET_MARKERS = ("ul.", "al.", "os.", "pl.")
EMAIL_PLACEHOLDER = "[email removed]"
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,}"
# --------------------------------------------------------------------------------

_WS_CLASS = r"(?U)[\s\x1c-\x1f]+"


def strip(col: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    """Trimmed value, or null when nothing is left."""
    return F.nullif(strip(col), F.lit(""))


def squeeze(col: Column) -> Column:
    """Trim and turn every run of white space into one space; blank becomes null."""
    return F.nullif(F.regexp_replace(strip(col), _WS_CLASS, " "), F.lit(""))


def words(col: Column) -> Column:
    """The white-space separated words of a value (empty array for blank)."""
    return F.filter(F.split(F.regexp_replace(strip(col), _WS_CLASS, " "), " "), lambda w: w != "")


def _capitalise(chunk: Column) -> Column:
    return F.concat(F.upper(F.substring(chunk, 1, 1)), F.lower(chunk.substr(F.lit(2), F.length(chunk))))


def _capitalise_chunk(chunk: Column) -> Column:
    # Leading "MC" groups that still have something after them, then the rest.
    big = F.upper(chunk)
    mc = F.regexp_extract(big, "^((?:MC)+)(.+)$", 1)
    rest = chunk.substr(F.length(mc) + 1, F.length(chunk))
    big_rest = F.upper(rest)
    cased = F.when(
        big_rest.isin(*MAC_NAMES), F.concat(F.lit("Mac"), _capitalise(rest.substr(F.lit(4), F.length(rest))))
    ).otherwise(_capitalise(rest))
    return F.concat(F.regexp_replace(mc, "MC", "Mc"), cased)


def _capitalise_word(word: Column) -> Column:
    def apostrophes(part: Column) -> Column:
        return F.array_join(F.transform(F.split(part, "'"), _capitalise_chunk), "'")

    return F.array_join(F.transform(F.split(word, "-"), apostrophes), "-")


def title_case(col: Column) -> Column:
    """Proper case for ALL-CAPS values; anything with a lower-case letter is kept.

    The guard makes the function idempotent and keeps deliberate casing.
    """

    def one(word: Column, position: Column) -> Column:
        big = F.upper(word)
        keep_upper = word.rlike(r"^[A-Za-z]\.?$") | big.isin(*ROMAN_SUFFIXES, *ACRONYMS)
        particle = (position > 0) & F.lower(word).isin(*PARTICLES)
        return (
            F.when(keep_upper, big).when(particle, F.lower(word)).otherwise(_capitalise_word(word))
        )

    shouted = col.rlike(r"\p{L}") & ~col.rlike(r"\p{javaLowerCase}")
    return F.when(shouted, F.array_join(F.transform(words(col), one), " ")).otherwise(col)


# The same matches without trying every start inside a word: a local part begins where no
# local-part character stands before it, or where the last match ended.
_LOCAL = "[A-Za-z0-9._%+-]"
_EMAIL_FAST = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++" + EMAIL_PATTERN.removeprefix(f"{_LOCAL}+")


def redact_emails(col: Column) -> Column:
    """Replace e-mail addresses with a marker so that the sentence stays readable.

    Texts without an at sign, nearly all of them, skip the expression.
    """
    return F.when(
        F.contains(col, F.lit("@")), F.regexp_replace(col, _EMAIL_FAST, EMAIL_PLACEHOLDER)
    ).otherwise(col)


def count_emails(col: Column) -> Column:
    """Number of addresses `redact_emails` replaces."""
    found = F.size(F.regexp_extract_all(col, F.lit(_EMAIL_FAST), F.lit(0)))
    return F.when(F.contains(col, F.lit("@")), found).when(col.isNotNull(), 0).cast("bigint")


def _fold_tables() -> tuple[str, str]:
    """Accented Latin letters and their base letters, derived from Unicode data."""
    source, target = [], []
    for code in range(0xC0, 0x250):
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if base != char and len(base) == 1:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _fold_tables()


def fold_key(col: Column) -> Column:
    """Header/name key: accents removed, lower case, single spaces.

    Combining marks are dropped and precomposed Latin letters mapped, which is what
    compatibility decomposition gives for the Latin headers this is used on.
    """
    bare = F.regexp_replace(F.translate(col, _ACCENTED, _PLAIN), r"\p{M}+", "")
    return F.lower(F.regexp_replace(strip(bare), _WS_CLASS, " "))


def fold_text(value: str) -> str:
    """Driver-side twin of `fold_key` for header cells."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
    return " ".join(plain.lower().split())


def split_western_name(col: Column) -> Column:
    """``struct(first, last)``: the surname is the last word with the lower-case
    particles and joiners before it; no character is lost.

    Two folds over the word list: one walks left from the last word, the other walks
    right over academic titles so that a title never starts the surname.
    """
    parts = words(col)
    count = F.size(parts)

    def at(index: Column) -> Column:  # zero-based, null outside
        return F.try_element_at(parts, index + 1)

    has_suffix = (count > 1) & F.coalesce(at(count - 1).isin(*NAME_SUFFIXES), F.lit(False))
    start = F.when(has_suffix, count - 2).otherwise(count - 1)
    steps = F.sequence(F.lit(1), F.greatest(count, F.lit(1)))

    def walk_left(i: Column, _step: Column) -> Column:
        before = at(i - 1)
        pulls = (i > 0) & F.coalesce(
            before.rlike(r"^\p{javaLowerCase}") & ~before.isin(*ACADEMIC_TITLES), F.lit(False)
        )
        joins = F.coalesce(before.isin(*SURNAME_JOINERS), F.lit(False)) & (i - 1 > 0)
        return F.when(pulls & joins, i - 2).when(pulls, i - 1).otherwise(i)

    def walk_right(i: Column, _step: Column) -> Column:
        titled = (i < count - 1) & F.coalesce(at(i).isin(*ACADEMIC_TITLES), F.lit(False))
        return F.when(titled, i + 1).otherwise(i)

    cut = F.aggregate(steps, start.cast("int"), walk_left)
    cut = F.aggregate(steps, cut.cast("int"), walk_right)
    pair = F.struct(cut.alias("cut"), parts.alias("parts"))
    # The fold is bound once through a one-element array so that it is not repeated.
    return F.element_at(
        F.transform(
            F.array(pair),
            lambda p: F.struct(
                F.nullif(F.array_join(F.slice(p["parts"], F.lit(1), F.greatest(p["cut"], F.lit(0))), " "), F.lit("")).alias("first"),
                F.nullif(
                    F.array_join(
                        F.slice(p["parts"], F.greatest(p["cut"], F.lit(0)) + 1, F.greatest(F.size(p["parts"]), F.lit(1))), " "
                    ),
                    F.lit(""),
                ).alias("last"),
            ),
        ),
        1,
    )


_HONORIFIC_LEAD = r"(?iu)^(?:(?:" + "|".join(HONORIFICS) + r")\.*(?:\s+|$))+"


def split_eastern_name(col: Column) -> Column:
    """``struct(first, last)`` for family-name-first names, leading honorifics dropped.

    A single remaining word is a given name.
    """
    parts = words(F.regexp_replace(F.regexp_replace(strip(col), _WS_CLASS, " "), _HONORIFIC_LEAD, ""))
    many = F.size(parts) > 1
    return F.struct(
        F.when(many, F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1))), " "))
        .otherwise(F.try_element_at(parts, F.lit(1)))
        .alias("first"),
        F.when(many, F.try_element_at(parts, F.lit(1))).alias("last"),
    )


def town_only(col: Column) -> Column:
    """The town in front of the first word with a digit or a street marker."""
    parts = words(col)
    bad = F.transform(parts, lambda w: w.rlike(r"(?U)\d") | F.lower(w).isin(*STREET_MARKERS))
    first_bad = F.array_position(bad, True).cast("int")
    kept = F.when(first_bad == 0, parts).otherwise(
        F.slice(parts, F.lit(1), F.greatest(first_bad - 1, F.lit(0)))
    )
    town = F.btrim(F.array_join(kept, " "), F.lit(" ,;-"))
    return F.when(town.rlike(r"\p{L}"), town)


def decode_numeric_entities(col: Column) -> Column:
    """Decode ``&#NN;`` and ``&#xHH;`` references.

    The value is cut at every reference, so each reference is decoded on its own and any
    code point is handled, not a fixed list.
    """
    pieces = F.regexp_extract_all(col, F.lit(r"(?s)(&#(?:[xX][0-9a-fA-F]+|[0-9]+);|&|[^&]+)"), F.lit(1))

    def piece(token: Column) -> Column:
        hexa = F.regexp_extract(token, r"^&#[xX]([0-9a-fA-F]+);$", 1)
        deci = F.regexp_extract(token, r"^&#([0-9]+);$", 1)
        code = F.when(hexa != "", F.conv(hexa, 16, 10)).when(deci != "", deci).cast("bigint")
        # UTF-32 bytes of the code point.
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(code.isNotNull(), char).otherwise(token)

    return F.when(
        col.contains("&#"), F.array_join(F.transform(pieces, piece), "")
    ).otherwise(col)


def wordless_to_null(col: Column) -> Column:
    """Null for placeholders that hold no letter, digit or underscore."""
    return F.when(col.rlike(r"(?U)\w"), col)


def repair_controls(col: Column) -> Column:
    """Restore the one leaked code-page byte (0x81 is ü) and delete other controls."""
    return F.regexp_replace(F.translate(col, "\x81", "ü"), r"[\x00-\x1f\x7f-\x9f]", "")


# Suffix abbreviations of boundary names and their long form (fixed values).
NAME_TAILS = {
    " nf": " national forest",
    " np": " national park",
    " sp": " state park",
    " sf": " state forest",
    " wma": " wildlife management area",
}


def boundary_name(col: Column, expand_tails: bool = True) -> Column:
    """Lower-case, single-spaced name for fuzzy matching; empty string for null."""
    name = strip(F.lower(F.coalesce(col, F.lit(""))))
    if expand_tails:
        for short, full in NAME_TAILS.items():
            name = F.regexp_replace(name, short + "$", full)
    return F.regexp_replace(strip(name), _WS_CLASS, " ")


def byte_translate(col: Column, codec: str) -> Column:
    """Re-read text that was decoded as ISO-8859-1 as another one-byte code page.

    ISO-8859-1 keeps byte values as code points, so one `translate` with the code
    page's upper half decodes it.  Works for code pages the CSV reader rejects.
    """
    high = range(0x80, 0x100)
    source = "".join(chr(b) for b in high)
    target = "".join(bytes([b]).decode(codec, errors="replace") for b in high)
    return F.translate(col, source, target)
