"""Column functions on golden values."""

import pytest
from pyspark.sql import functions as F

from regweave.functions import address, dates, grid, labels, numbers, text


def run(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_title_case(spark):
    pairs = {
        "SMITH": "Smith", "SALT LAKE CITY": "Salt Lake City", "MCDONALD": "McDonald", "MCMCX": "McMcX", "MC": "Mc",
        "MACEY": "Macey", "MACDONALD": "MacDonald", "O'BRIEN-D'ARCY": "O'Brien-D'Arcy", "JOHN SMITH III": "John Smith III",
        "J. R. SMITH": "J. R. Smith", "JOHN VON NEUMANN": "John von Neumann", "DE LA CRUZ": "De la Cruz", "RIVER ARC": "River ARC",
        "ST. LOUIS": "St. Louis", "McDonald": "McDonald", "iPhone City": "iPhone City", "123": "123", "": "", "A  B": "A B",
    }
    assert run(spark, text.title_case, list(pairs)) == list(pairs.values())
    assert run(spark, text.title_case, list(pairs.values())) == list(pairs.values())


def test_strip_handles_no_break_space(spark):
    assert run(spark, text.blank_to_null, ["  x ", "   ", None]) == ["x", None, None]
    assert run(spark, text.squeeze, [" a   b\t", "  "]) == ["a b", None]


@pytest.mark.parametrize(
    ("name", "first", "last"),
    [
        ("Erika Mustermann", "Erika", "Mustermann"), ("Hans-Peter von der Heide", "Hans-Peter", "von der Heide"),
        ("Dr. Max Beispiel", "Dr. Max", "Beispiel"), ("Anna Müller geb. Schmidt", "Anna", "Müller geb. Schmidt"),
        ("Dr.", None, "Dr."), ("Karl Otto jun.", "Karl", "Otto jun."), ("X", None, "X"), ("", None, None),
    ],
)
def test_western_name(spark, name, first, last):
    out = run(spark, text.split_western_name, [name])[0]
    assert (out.first, out.last) == (first, last)


def test_eastern_name(spark):
    out = run(spark, text.split_eastern_name, ["Példa Ödön", "Dr. Példa Ödön Béla", "ifj. Kis", "Dr.", None])
    assert [(o.first, o.last) for o in out] == [
        ("Ödön", "Példa"), ("Ödön Béla", "Példa"), ("Kis", None), (None, None), (None, None)]


def test_town_only(spark):
    values = ["Gliczarów Górny 158", "Pogrzebień ul. Lubomska 16 B", "Kraków,", "12", None]
    assert run(spark, text.town_only, values) == ["Gliczarów Górny", "Pogrzebień", "Kraków", None, None]


def test_small_text_functions(spark):
    assert run(spark, text.decode_numeric_entities, ["O&#x27;B &amp; &#65;&", "&#128512;", None]) == ["O'B &amp; A&", "\U0001f600", None]
    assert run(spark, text.wordless_to_null, ["**", "-", "a", "é"]) == [None, None, "a", "é"]
    assert run(spark, text.repair_controls, ["M\x81nchen", "a\x7fb"]) == ["München", "ab"]
    assert run(spark, text.fold_key, [" Señal  Distintiva", "Categoría"]) == ["senal distintiva", "categoria"]
    assert run(spark, text.redact_emails, ["mail a.b+c@x.example.org now", "TG@22208"]) == ["mail [email removed] now", "TG@22208"]
    assert run(spark, text.boundary_name, [" Boise  NF ", None, "Nf Park"]) == ["boise national forest", "", "nf park"]
    assert run(spark, lambda c: text.byte_translate(c, "cp865"), ["Troms\x9b"]) == ["Tromsø"]


def test_dates(spark):
    assert run(spark, dates.us_date_or_same, ["1/2/2020", "x/y", None]) == ["2020-01-02", "x/y", None]
    assert run(spark, dates.slash_date, ["31/10/2023", "31/02/2023", "N/I", None]) == ["2023-10-31", None, None, None]
    assert run(spark, dates.dotted_date, ["5.10.2026", "31.2.2026", "Oslo"]) == ["2026-10-05", None, None]
    assert run(spark, dates.slash_date_or_same, ["1/2/2020", " 2020-01-01", " "]) == ["2020-02-01", "2020-01-01", None]
    assert run(spark, dates.spanish_month_date, ["30 Abr. 2029", "7 Set. 2026", "31 Feb 2020"]) == ["2029-04-30", "2026-09-07", None]
    assert run(spark, dates.german_edition_date, ["x vom 23. Oktober 2026 y", "no"]) == ["2026-10-23", None]
    assert run(spark, dates.dotted_edition_date, ["List 99.99.2026 5.10.2026.csv"]) == ["2026-10-05"]
    assert run(spark, dates.iso_date, ["2026-01-02", "20260102", "2026-02-30"]) == ["2026-01-02", None, None]


def test_grid(spark):
    rows = [(41.7, -72.7, "FN31"), (-33.9, 151.2, "QF56"), (0.0, 0.0, "JJ00"), (51.5, -0.1, "IO91"), (-34.6, -58.4, "GF05"),
            (90.0, 180.0, "RR99"), (-90.0, -180.0, "AA00"), (None, 1.0, None)]
    df = spark.createDataFrame(rows, "lat double, lon double, want string")
    out = df.select("want", grid.grid4(F.col("lat"), F.col("lon")).alias("g"), grid.grid6(F.col("lat"), F.col("lon")).alias("h")).collect()
    for r in out:
        assert r.g == r.want
        assert r.h is None or (len(r.h) == 6 and r.h[:4] == r.g and r.h[4:].islower())


FLAGGED = [
    "10 Sample Rd", "20 SAMPLE STREET", "23B Sample Street", "1234 Nowhere Pl NW", "30 Test Ct. Somewhere", "50 Sample Ave #101",
    "12 rue Fictive", "14 Boul. Exemple", "22nd St S", "12-34 Fake Road", "Waldstr. 35 A", "Musterstraße 12", "Storgata 10B",
    "ul. Przykładowa 5", "Calle Falsa 123", "Barrio San Ramon Lote 245", "Manzana 4 Casa 12", "1435", "88 Sample Trail",
]
SPARED = [
    "29 Palms", "100 Mile House", "Six Mile", "St. Louis", "Port St Lucie", "10407 Berlin, DE", "Fort Drive-In",
    "1. Kolbotn gruppe av Norges Speiderforbund", "Smith", "", None, "9 de Julio", "Comuna 1", "Neustadt an der Weinstraße", "5ta Seccion",
]


def test_address_shapes(spark):
    assert run(spark, address.looks_like_street_address, FLAGGED) == [True] * len(FLAGGED)
    assert run(spark, address.looks_like_street_address, SPARED) == [False] * len(SPARED)


def test_location_shapes(spark):
    bad = ["Anytown, IA, 1431 Sample St", "239 Sample Av", "12 Sample Strete", "7 Sample", "Town, 12B Sample", "99/3 Sample2, Land", "29 Palms, CA"]
    good = ["Anytown, IA", "Grid EN31", "Anytown, IA, 50000", "With 10,000 mah Battery", "75001 Paris", "443.825 Repeater", "220 MHz Repeater",
            "2m Town, IA", "6M FM Hub", "10 Miles N. of Town", "108 Mile Ranch, BC", "Town 12 Sample", "", None]
    assert run(spark, address.location_has_street_address, bad) == [True] * len(bad)
    assert run(spark, address.location_has_street_address, good) == [False] * len(good)


def test_echo(spark):
    rows = [
        ("300 Test Ct. Somewhere", "300 Test Ct.", True), ("400 Example Water Cov", "400 EXAMPLE WATER COVE", True),
        ("Pawleys Island", "PAWLEYS ISLAND", False), ("29 Palms", "29 PALMS HWY", False), ("1100 Fake Rd", "100 FAKE RD", False),
        (None, "100 FAKE RD", False), ("100 Fake Rd", None, False),
    ]
    df = spark.createDataFrame(rows, "v string, s string, want boolean")
    for r in df.select("want", address.echoes_street(F.col("v"), [F.lit(None).cast("string"), F.col("s")]).alias("got"), "v").collect():
        assert r.got == r.want, r.v


def test_labels(spark):
    assert run(spark, labels.postal_area, ["k1g 0z5", "K1G", "90210", None]) == ["K1G", "K1G", None, None]
    assert run(spark, labels.first_subdivision, ["US-ME,US-NH", "XX", "", None]) == ["ME", "XX", None, None]
    assert run(spark, labels.bare_host, ["h.net", "https://h/", "h/p", "a b", " "]) == ["h.net", None, None, None, None]
    assert run(spark, labels.wire_name, ["XLX836", "xlxarg", "XRF001", "XLX12"]) == ["XRF836", "XRFARG", None, None]
    assert run(spark, labels.precedence_rank, ["fcc", "uke", "zz", None]) == [0, 9, 10, 10]
    assert run(spark, labels.row_license, ["dvref", "xlx", None]) == ["CC-BY-4.0", "none-stated", "none-stated"]
    people = [("5", "X"), ("6", "Valley Radio Club"), ("6", "J Sampleperson"), ("6", "Nominee X club"), ("7", "Club"), (None, "Club"), ("", None)]
    df = spark.createDataFrame(people, "t string, n string")
    got = [r[0] for r in df.select(labels.is_natural_person(F.col("t"), F.col("n"))).collect()]
    assert got == [False, False, True, True, True, True, True]


def test_numbers(spark):
    assert run(spark, numbers.to_whole, ["12", "12.9", "-1.5", "x", " "]) == [12, 12, -1, None, None]
    assert run(spark, numbers.digits_only, ["12", " 7 ", "1.5", "x", None]) == [12, 7, None, None, None]
    assert run(spark, numbers.active_flag, [None, "0", "1", "true", "false", "yes"]) == [True, False, True, True, False, True]
    assert run(spark, lambda c: numbers.active_until(c, "2026-01-01"), ["2026-01-01", "2025-12-31", None, "odd"]) == [True, False, True, True]


def test_address_detectors_take_texts_of_any_length(spark):
    from regweave.functions.address import location_has_street_address, looks_like_street_address

    words = "oak " * 50_000
    df = spark.createDataFrame([(f"12 {words}road",), (f"12 {words}",), (words,)], "v string")
    got = df.select(looks_like_street_address(F.col("v")), location_has_street_address(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, True), (False, False)]
