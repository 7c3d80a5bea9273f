"""Readers on small files written by the tests."""

import json

import pytest

from regweave.operators.guards import GateError
from regweave.sources import base, delimited, directory, reference, registers


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
    return str(path)


def rows(df, *cols, order="callsign"):
    return [tuple(r) for r in df.orderBy(order).select(*cols).collect()]


def pipe(values, width):
    cells = [""] * width
    for index, value in values.items():
        cells[index] = value
    return "|".join(cells)


def test_us(spark, tmp_path):
    head = lambda usi, call, status, **d: pipe({0: "HD", 1: usi, 4: call, 5: status, 7: d.get("g", ""), 8: d.get("x", "")}, 43)
    put(tmp_path / "HD.dat", "\n".join([head("1", "W1AA", "E"), head("1", "W1AA", "A", g="1/2/2015", x="01/02/2025"), "",
                                          head("2", "K2BB", "E"), head("3", "K3CC", "A")]))
    ent = lambda usi, call, first, last, street, city: pipe({1: usi, 4: call, 5: "L", 8: first, 10: last, 15: street, 16: city, 17: "CT", 23: "I"}, 24)
    put(tmp_path / "EN.dat", "\n".join([ent("1", "W1AA", "Ana", "N\xfa\xf1ez", "5 Pond Rd", "5 POND RD"), ent("2", "K2BB", "B", "B", "", "X"),
                                          ent("3", "K3CC", " ", "Club", "1 Main St", "Boise"), ent("9", "K9", "", "", "", "")]), "latin-1")
    put(tmp_path / "AM.dat", "\n".join([pipe({1: "1", 5: "G"}, 16), pipe({1: "1", 5: "E", 15: "W1OLD"}, 16), pipe({1: "3", 5: "Q"}, 6)]))
    out = registers.read_us(spark, str(tmp_path), "2026-01-01")
    assert rows(out, "callsign", "first_name", "last_name", "city", "license_class", "grant_date", "expired_date", "previous_callsign",
                "applicant_type") == [
        ("K3CC", None, "Club", "Boise", "Q", None, None, None, "Individual"),
        ("W1AA", "Ana", "Núñez", None, "Amateur Extra", "2015-01-02", "2025-01-02", "W1OLD", "Individual"),
    ]
    assert registers.read_us(spark, str(tmp_path), active_only=False).count() == 3


def au_files(folder, headed):
    client = [["11", "Valley Radio Club Inc", "", "", "", "PO Box 12", "KATOOMBA", "NSW", "2780", "1", "6"],
              ["12", "Alex Sample", "", "", "", "9 Sample St", "TOWN", "VIC", "3000", "1", "7"],
              ["13", 'Co "A", Pty Ltd', "", "", "", "1 Rd", "BRIS", "QLD", "4000", "1", "5"]]
    licence = [["L1/1", "11", "", "", "Amateur", "Repeater", "2020-01-01", "2020-01-02", "2027-01-01", "1", "Granted"],
               ["L2/1", "12", "", "", "Amateur", "Advanced", "", "", "", "1", "Granted"],
               ["L3/1", "13", "", "", "Land Mobile", "X", "", "", "", "1", "Granted"],
               ["L4/1", "13", "", "", "Amateur Beacon", "Beacon", "", "", "", "1", "granted"],
               ["L5/1", "13", "", "", "Amateur", "Y", "", "", "", "1", "Cancelled"]]
    device = []
    for lic, call in (("L1/1", "vk2rxx"), ("L1/1", "VK2RXX"), ("L2/1", "VK3AA"), ("L3/1", "VKTEL"), ("L4/1", "VK4BEA"), ("L5/1", "VK5C")):
        device.append(["1", lic] + [""] * 31 + [call])
    quote = lambda c: '"' + c.replace('"', '""') + '"' if "," in c or '"' in c else c
    names = {"client.csv": (client, registers.AU_CLIENT), "licence.csv": (licence, registers.AU_LICENCE), "device_details.csv": (device, registers.AU_DEVICE)}
    for name, (data, layout) in names.items():
        lines = [",".join(quote(c) for c in r) for r in data]
        if headed:  # same columns, with one more in front
            width = len(data[0])
            head = ["COL%d" % i for i in range(width)]
            for column, index in layout.items():
                head[index] = column
            first = {"client.csv": "CLIENT_NO", "licence.csv": "LICENCE_NO", "device_details.csv": "SDD_ID"}[name]
            head = [first if i == 0 else h for i, h in enumerate(head)]
            # Move the last column to the second place.
            lines = [",".join(quote(c) for c in [r[0], r[-1], *r[1:-1]]) for r in [head, *data]]
        put(folder / name, "\n".join(lines) + "\n", "latin-1")
    put(folder / "client_type.csv", ("TYPE_ID,NAME\n" if headed else "") + "5,Firm\n6,Group\n")


@pytest.mark.parametrize("headed", [False, True])
def test_au(spark, tmp_path, headed):
    au_files(tmp_path, headed)
    out = registers.read_au(spark, str(tmp_path))
    assert rows(out, "callsign", "last_name", "city", "license_class", "applicant_type", "expired_date") == [
        ("VK2RXX", "Valley Radio Club Inc", "KATOOMBA", "Repeater", "Group", "2027-01-01"),
        ("VK3AA", None, None, "Advanced", "Person", None),
        ("VK4BEA", 'Co "A", Pty Ltd', "BRIS", "Beacon", "Firm", None),
    ]


def ca_line(call, given="", surname="", street="", city="", province="", postal="", flags="", club=None):
    f = [" "] * 9
    for i, c in enumerate(flags):
        f[i * 2] = c
    line = f"{call:<7}{given:<36}{surname:<36}{street:<71}{city:<36}{province:<3}{postal:<11}" + "".join(f) + " "
    if club:
        line += f"{club[0]:<71}{'':<71}{club[1]:<71}{club[2]:<36}{club[3]:<3}{club[4]:<7}"
    return line


def test_ca(spark, tmp_path):
    text = "\n".join([
        "2026-11-01   Canadian Amateur Call Sign List", "", ca_line("VE1AA", "Zoë", "O&#x27;Neil", "1 Main St", "Halifax", "NS", "B3H 4R2", "A  D".replace(" ", " ")),
        ca_line("VA2CLB", "Trustee", "Person", "2 Elm Rd", "X", "QC", "H1A 1A1", "A", ("2 Club Road", "2 CLUB ROAD", "Laval", "QC", "H7A 0A1")),
        ca_line("VE3B", "Ann", "Lee", "", "**", "ON", "90210", " "), "There are 3 call signs in this report", "EOF",
    ])
    out = registers.read_ca(spark, put(tmp_path / "amateur.txt", text))
    got = {r[0]: r[1:] for r in rows(out, "callsign", "first_name", "last_name", "city", "state", "postal_code", "license_class")}
    assert got["VE1AA"] == ("Zoë", "O'Neil", "Halifax", "NS", "B3H", "Basic, Advanced")
    assert got["VA2CLB"] == (None, None, "Laval", "QC", "H7A", "Basic")
    assert got["VE3B"] == ("Ann", "Lee", None, "ON", None, None)
    latin = registers.read_ca(spark, put(tmp_path / "latin.txt", ca_line("VE1AA", "Zo\xeb", "N", flags="A"), "latin-1"))
    assert latin.first().first_name == "Zoë"
    broken = registers.read_ca(spark, put(tmp_path / "bad.txt", "something else entirely\n"))
    with pytest.raises(Exception, match="not a fixed-width"):
        broken.collect()


def test_br(spark, tmp_path):
    head = ";".join(registers.BR_COLUMNS)
    line = lambda *v: ";".join(v)
    text = "\ufeff" + "\n".join([
        head,
        line("CPF", "Fulana  Exemplo", "pu5zza", "SC", "Classe C", "N/I", "Vila Um", "SC", "31/10/2023", "31/10/2023", "N/I"),
        line("CPF", "Outra", "PU5ZZA", "SC", "N/A", "Fixa", "Vila Dois", "RS", "01/10/2023", "02/11/2023", "31/12/2033"),
        line("CNPJ", "Clube", "PY2ZZB", "SP", "Classe B", "Fixa", "N/I", "N/I", "", "", ""), line("CPF", "X", "W1AW", "SP", "", "", "", "", "", "", ""),
    ])
    out = registers.read_br(spark, put(tmp_path / "e.csv", text))
    assert rows(out, "callsign", "last_name", "city", "state", "license_class", "grant_date", "effective_date", "expired_date", "applicant_type") == [
        ("PU5ZZA", "Fulana Exemplo", "Vila Dois", "RS", "Classe C", "2023-10-01", "2023-11-02", "2033-12-31", "Individual"),
        ("PY2ZZB", "Clube", None, "SP", "Classe B", None, None, None, "Organization"),
    ]
    with pytest.raises(GateError, match="COER"):
        registers.read_br(spark, put(tmp_path / "bad.csv", head.replace("COER", "X") + "\n"))


@pytest.mark.parametrize("codec", ["cp865", "utf-8", "cp1252"])
def test_no(spark, tmp_path, codec):
    head = ";".join(registers.NO_COLUMNS)
    text = "\n".join([
        head, "la1aa;;Kåre;Ås;Storgata 1;;0150;Tromsø;Norge ;personlig;31.12.2030", "LA1AA;;Again;X;;;;;;personlig;",
        "LB2CC;Klubb  X;Kari;N;;;622;Berlin;Tyskland;Ny type;Oslo", "LC3D;;A;Storgata 10;Storgata 10;;24180;Storgata 10;;;1.2.2030", ";;;;;;;;;;", "W1AW;;A;B;;;;;;;",
    ])
    out = registers.read_no(spark, put(tmp_path / "l.csv", text, codec))
    assert rows(out, "callsign", "first_name", "last_name", "city", "postal_code", "expired_date", "applicant_type") == [
        ("LA1AA", "Kåre", "Ås", "Tromsø", "0150", "2030-12-31", "Person"), ("LB2CC", None, "Klubb X", None, None, None, "Ny type"),
        ("LC3D", "A", None, None, None, "2030-02-01", None),
    ]


def test_pl(spark, tmp_path):
    put(tmp_path / "individuals.csv", "number;valid_to;call_sign;category;station_location\n1;2030-01-01;sp1aa;Kategoria1;Łódź 12\n2;2031-01-01;SP1AA;Kategoria3;Łódź\n3;;XX1;Kategoria1;A\n", "cp1250")
    put(tmp_path / "clubs.csv", "call_sign;valid_to;category;enduser_name;applicant_name;station_city;station_street;station_house;lat;lng\n"
        'SP2CL;2030-01-01;Dodatkowe;"Klub ""X""";Owner;Koniewo 12;Koniewo;12;52,1;21.0\nSP3CL;;Inna;;Lesna 14;Wies;Lesna;14;0;0\n')
    for name in ("individual_devices.csv", "club_devices.csv"):
        put(tmp_path / name, "valid_to;call_sign;category\n2040-01-01;SR9X;Kategoria5\n")
    out = registers.read_pl(spark, str(tmp_path))
    assert rows(out, "callsign", "last_name", "city", "grid", "license_class", "expired_date", "applicant_type") == [
        ("SP1AA", None, "Łódź", None, "Category 3", "2031-01-01", "Individual"),
        ("SP2CL", 'Klub "X"', "Koniewo", "KO02", "Additional", "2030-01-01", "Club"),
        ("SP3CL", None, "Wies", None, "Inna", None, "Club"), ("SR9X", None, None, None, "Category 5", "2040-01-01", "Unattended station"),
    ]


def ar_page(rows_, declared, column="Radioaficionado"):
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>\n" for r in rows_)
    head = "".join(f"<th>{h}</th>" for h in (column, "Categor&iacute;a".replace("&iacute;", "í"), "Señal Distintiva", "Vence", "Ciudad", "Provincia"))
    return (f"<html><table><tr><td>other</td></tr></table><p>Registros encontrados: {declared}</p><table class='x listado'>\n"
            f"<thead><tr>{head}</tr></thead>{body}</table><table><tr><td>tail</td></tr></table></html>")


def test_ar(spark, tmp_path):
    people = [("N&#250;&ntilde;ez".replace("&ntilde;", "ñ"), "NOVICIO", "lu1aaa", "x", " La  <b>Plata</b>", "CÓRDOBA"), ("B", "", "XX1", "", "", "")]
    put(tmp_path / "todos.html", ar_page(people, 2))
    put(tmp_path / "instituciones.html", ar_page([("Club &amp; Co", "SUPERIOR", "LU1AAA", "", "", ""), ("Club", "SUPERIOR", "LU2BB", "", "", "OTRA")], 2, "Institución"))
    out = registers.read_ar(spark, str(tmp_path))
    assert rows(out, "callsign", "last_name", "city", "state", "license_class", "applicant_type") == [
        ("LU1AAA", "Núñez", "La Plata", "Córdoba", "Novicio", "Individual"), ("LU2BB", "Club", None, "OTRA", "Superior", "Organization"),
    ]
    put(tmp_path / "bad" / "todos.html", ar_page(people, 3))
    put(tmp_path / "bad" / "instituciones.html", ar_page([], 0))
    with pytest.raises(GateError, match="page says 3"):
        registers.read_ar(spark, str(tmp_path / "bad"))


def test_uy(spark):
    data = [("cx1aa", "IARP", "A", "x", "GENERAL", "30 Abr. 2035", 0), ("CX1AA", "Fijo", "B", "y", "GENERAL", "2030-01-01", 1), ("CX1AA", "Fijo", "C", None, None, "7 Set. 2031", 2),
            ("K1ABC/CX", "IARP", "V", "v", None, None, 3), ("BAD", None, None, None, None, None, 4)]
    df = spark.createDataFrame(data, "callsign string, permit string, surnames string, given string, class string, expiry string, k long").withColumn("_ord", base.table_order("k"))
    assert rows(registers.uy_records(df), "callsign", "last_name", "first_name", "expired_date", "applicant_type") == [("CX1AA", "C", None, "2031-09-07", "Organization")]


def test_hu(spark, tmp_path):
    titles = ["No", "Call Sign", "Name of licensee", "City", "Utca", "Validity", "ENG.KAT", "Morse", "Felelős kezelő", "Státusz"]

    def row(cells):
        out, expect = "", 1
        for i, value in enumerate(cells, start=1):
            if value is None:
                continue
            mark = f' ss:Index="{i}"' if i != expect else ""
            out += f'<Cell{mark}><Data ss:Type="String">{value}</Data></Cell>'
            expect = i + 1
        return f"<Row>{out}</Row>"

    body = [titles, ["1", "ha1aa", "Dr. Példa Ödön", "Pécs", "Fenyves sor", "2030-01-01T00:00", "A", None, None, "Kiadott"],
            ["2", "HA1AA", "Példa Ödön", "Fenyves sor", "Fenyves sor", "2031-05-05", "A", "Igen", "Példa Ödön", "Kiadott"],
            ["3", "HG5CLB", "Klub &amp; Co", None, None, None, None, None, "Vezető", "Kiadott"], ["4", "HA9X", "Y", None, None, None, None, None, None, "Lejárt"]]
    text = '<?xml version="1.0"?><Workbook xmlns:ss="urn:x"><Worksheet><Table>' + "\n".join(row(r) for r in body) + "</Table></Worksheet></Workbook>"
    out = registers.read_hu(spark, put(tmp_path / "b.xml", text))
    assert rows(out, "callsign", "first_name", "last_name", "city", "license_class", "expired_date", "applicant_type") == [
        ("HA1AA", "Ödön", "Példa", None, "A, Igen", "2031-05-05", None), ("HG5CLB", None, "Klub & Co", None, None, None, "Club"),
    ]
    with pytest.raises(GateError, match="refused"):
        registers.read_hu(spark, put(tmp_path / "dtd.xml", "<!DOCTYPE x>" + text))


def test_de(spark):
    pages = {
        1: ["vom 23. Oktober 2026"], 2: ["Inhalt", "1 Liste der personengebundenen ....... 2", "und mehr ..... 3"],
        3: ["Seite 3", "1 Liste der personengebundenen Rufzeichen", "gemäß Gesetz", "", "DA1AA, A, Erika Mustermann; Musterstr. 12, 38100 Braunschweig",
            "DB1XY, A, Hans-Peter von der Heide; Am Weiher 3 b, 36456 Barchfeld-", "Immelborn, Bahnhofstr. 2,", ],
        4: ["Seite 4", "36433 Bad Salzungen", "DC1AB, E, Dr. Max Beispiel", "DC1ZZ, Q, Wrong Class; X 1, 12345 Y", "rest of it", "DD2A, A, Eva Eins,; Weg 1, 4617 Starkenberg"],
        5: ["2 Liste der Rufzeichen für Ausbildungsfunkbetrieb", "DA0CC, A, Karl M\x81ller; Weg 2, 2628 AB Delft", "DA1AA, A, Second Entry"],
    }
    data = [("d", p, i, line) for p, lines in pages.items() for i, line in enumerate(lines)]
    df = spark.createDataFrame(data, "doc string, page long, line_no long, text string")
    from regweave.operators.assemble import callbook_entries

    entries, problems = callbook_entries(df)
    got = {r.callsign: r for r in entries.filter("list_no = 1").collect()}
    assert got["DB1XY"].entry_text == "Hans-Peter von der Heide; Am Weiher 3 b, 36456 Barchfeld-Immelborn, Bahnhofstr. 2, 36433 Bad Salzungen"
    assert got["DC1ZZ"].rejected and got["DC1ZZ"].entry_text.endswith("rest of it") and problems.count() == 0
    assert rows(registers.de_records(entries), "callsign", "first_name", "last_name", "city", "postal_code", "license_class", "applicant_type") == [
        ("DA0CC", "Karl", "Müller", None, None, "A", "Training station"), ("DA1AA", "Erika", "Mustermann", "Braunschweig", "38100", "A", "Individual"),
        ("DB1XY", "Hans-Peter", "von der Heide", "Barchfeld-Immelborn", "36456", "A", "Individual"), ("DC1AB", "Dr. Max", "Beispiel", None, None, "E", "Individual"),
        ("DD2A", "Eva", "Eins", "Starkenberg", None, "A", "Individual"),
    ]
    bad = df.unionByName(spark.createDataFrame([("d", 5, 9, "DA0AA, A, Too Late")], df.schema)).unionByName(
        spark.createDataFrame([("e", 1, 0, "1 Liste der personengebundenen"), ("e", 1, 1, ""), ("e", 1, 2, "stray")], df.schema))
    assert sorted(r.problem for r in callbook_entries(bad)[1].collect()) == ["out of order", "stray line"]


def test_entities(spark, tmp_path):
    text = ("United States:  05:  08:  NA:   37.53:    91.67:     5.0:  K:\n    AA,K,W,\n    =W1AW(05)[08],=K7RA;\n"
            "Hawaii:  31:  61:  OC:   21.12:   157.48:   -10.0:  KH6:\n    AH6,KH6<21.12/157.48>,K{NA};\nbroken;\n")
    numbers = '"K","United States","291","NA"\n"KH6","Hawaii","110","OC"\n"KH6","Hawaii","111","OC"\n"X","bad","n/a"\n'
    out = reference.read_entities(spark, put(tmp_path / "e.dat", text), put(tmp_path / "e.csv", numbers))
    got = {(r.key, r.is_exact): (r.entity, r.number) for r in out.collect()}
    assert got == {("AA", False): ("United States", 291), ("K", False): ("United States", 291), ("W", False): ("United States", 291),
                   ("W1AW", True): ("United States", 291), ("K7RA", True): ("United States", 291), ("AH6", False): ("Hawaii", 111), ("KH6", False): ("Hawaii", 111)}


def test_nodes_and_activity(spark, tmp_path):
    path = put(tmp_path / "n.txt", "2000|WB6|Hub|Los Angeles, CA\n2000|WB6|again|X\n40|w1aw|mail a@b.org|1 Main St\n\nx|K1|a|b\n5|K2|a\n7||a|b\n")
    report = reference.read_nodes(spark, path)
    assert rows(reference.node_directory(report), "node", "callsign", "description", "location", order="node") == [
        ("2000", "WB6", "Hub", "Los Angeles, CA"), ("40", "W1AW", "mail [email removed]", None)]
    assert {r.reason: r.n for r in reference.node_drop_counts(report).collect()} == {"field_count": 1, "node_number": 2, "duplicate": 1, "address": 1}
    pairs = reference.node_pairs(base.read_lines(spark, path))
    assert sorted((r.callsign, r.node) for r in pairs.collect()) == [("K2", 5), ("W1AW", 40), ("WB6", 2000), ("WB6", 2000)]
    act = reference.read_activity(spark, put(tmp_path / "a.csv", "w1aw,2026-05-01,01:02:03\nW1AW,2026-06-15,09:00:00,EXTRA\nBAD,not-a-date,0\n,2026-01-01,0\n"))
    assert sorted((r.callsign, r.day) for r in act.collect()) == [("W1AW", "2026-05-01"), ("W1AW", "2026-06-15")]


def test_centroids_parks_summits(spark, tmp_path):
    postal = put(tmp_path / "p.json", json.dumps([{"country": "United States", "postal_code": "06111", "lat": 1.0, "lon": 2.0}] * 2))
    assert reference.read_postal_centroids(spark, postal).count() == 1
    city = put(tmp_path / "c.json", json.dumps([{"country": "X", "city": "Y", "lat": 1.0, "lon": 2.0}]))
    assert reference.read_city_centroids(spark, city).first().state == ""
    put(tmp_path / "k" / "parks_US.json", json.dumps([{"reference": "US-1", "name": "A", "latitude": 44.5, "longitude": "-68", "grid": " FN54 ", "locationDesc": "US-ME,US-NH"},
                                                     {"reference": "US-2", "active": 0, "grid": None}, {"name": "no key"}, {"reference": "US-1", "name": "dup"}]))
    put(tmp_path / "k" / "parks_CA.json", json.dumps([{"reference": "CA-1", "isActive": True}]))
    assert rows(reference.read_parks(spark, str(tmp_path / "k"), "2026-01-01"), "reference", "name", "region", "country", "grid", "lat", "lon", "active", order="reference") == [
        ("CA-1", None, None, "CA", None, None, None, True), ("US-1", "A", "ME", "US", "FN54", 44.5, -68.0, True), ("US-2", None, None, "US", None, None, None, False)]
    head = ",".join(reference.SUMMIT_COLUMNS)
    text = f'SOTA Summits List (Date=18/06/2026)\n{head}\nG/1,"Eng, X",R,Peak,978,3209,0,0,-3.25,54.5,8,3,01/07/2002,31/12/2099,1,,\nG/1,dup,,,,,,,,,,,,,,,\nW/2,A,R,Old,1.9,x,0,0,,54,1,0,01/05/2010,31/12/2010,5,,\n'
    assert rows(reference.read_summits(spark, put(tmp_path / "s.csv", text), "2026-06-18"), "reference", "association", "alt_m", "alt_ft", "grid", "valid_from", "valid_to", "active", order="reference") == [
        ("G/1", "Eng, X", 978, 3209, "IO84jm", "2002-07-01", "2099-12-31", True), ("W/2", "A", 1, None, None, "2010-05-01", "2010-12-31", False)]


def test_registry_and_hosts(spark, tmp_path):
    def reflector(name, ip, last, comment="c"):
        return f"<reflector>\n <name>{name}</name><lastip>{ip}</lastip><lastcontact>{last}</lastcontact><country>X</country><comment>{comment}</comment></reflector>"

    now = 1_700_000_000
    text = "<XLXAPI><reflectorlist>" + reflector("XLX836", "1.1.1.1", now, "A <> B & C, x@y.org") + reflector("XLX001", "2.2.2.2", now - 40 * 86400) + reflector("XLXARG", "", now) + reflector("URF1", "3.3.3.3", "") + "</reflectorlist></XLXAPI>"
    out = directory.read_registry(spark, put(tmp_path / "x.xml", text), now, "2026-01-01")
    assert rows(out, "id", "aliases", "callsign", "host", "port", "description", "license", order="id") == [
        ("URF1", [], None, "3.3.3.3", 30001, "c", "none-stated"), ("XLX836", ["XRF836"], "XRF836", "1.1.1.1", 30001, "A <> B & C, [email removed]", "none-stated")]
    hosts = put(tmp_path / "h.txt", "# c\nXRF002\t5.5.5.5\n  xrf836   1.1.1.1\nXRF999\nNOPE 1.2.3.4\n")
    assert rows(directory.read_hosts(spark, hosts), "id", "host", order="id") == [("XRF002", "5.5.5.5"), ("XRF836", "1.1.1.1")]
    names = directory.read_alias_files(spark, [put(tmp_path / "p.txt", "REF836 1.1.1.1\nDB0LJ 1.1.1.1\n"), put(tmp_path / "d.txt", "DCS836 1.1.1.1\nREF836 1.1.1.1\n")])
    from regweave.operators.directory import attach_aliases
    from regweave.schemas import REFLECTOR, conform

    both = attach_aliases(conform(out, REFLECTOR), names)
    assert rows(both, "id", "aliases", "alias_source", order="id") == [("URF1", [], None), ("XLX836", ["XRF836", "REF836", "DCS836"], "pistar")]


def test_json_sources(spark, tmp_path):
    put(tmp_path / "ysf.json", json.dumps({"data": {"reflectors": [
        {"designator": 14, "name": "A", "dns": "a.net", "port": 41401, "modules": ["b", {"module": "A"}, "zz", "B"]},
        {"designator": "00006", "dns": None, "ipv4": "1.2.3.4", "port": None}, {"designator": "x"}, {"name": "N", "ipv6": "::1", "port": "77"}]}}))
    pay = directory.read_payloads(spark, str(tmp_path / "ysf.json"))
    assert rows(directory.network_records(pay, "ysf", "d"), "id", "name", "host", "port", "modules", "license", order="id") == [
        ("00006", "00006", "1.2.3.4", None, [], "CC-BY-4.0"), ("14", "A", "a.net", 41401, ["A", "B"], "CC-BY-4.0"), ("N", "N", "::1", 77, [], "CC-BY-4.0")]
    put(tmp_path / "talkgroups-net-a.json", json.dumps({"data": {"network": {"talkgroups": [{"tg": 80, "name": "x a@b.org"}, {"tg": 80, "name": "dup"}, {"name": "none"}]}}}))
    tg = directory.talkgroup_rows(directory.read_payloads(spark, str(tmp_path / "talkgroups-net-a.json")), "d")
    assert [tuple(r) for r in tg.collect()] == [("net-a", 80, "x [email removed]", "d")]


def test_file_date(spark, tmp_path):
    path = put(tmp_path / "f.txt", "x\n")
    import os

    os.utime(path, (86400 * 20000, 86400 * 20000))
    assert spark.read.text(path).select(base.file_date().alias("d")).first().d == "2024-10-04"


def test_order_survives_small_splits(spark, tmp_path):
    path = put(tmp_path / "big.txt", "".join(f"line {i}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = base.read_lines(spark, path)
        got = [r.value for r in lines.orderBy("_ord").collect()]
        assert lines.rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"line {i}" for i in range(3000)]


def test_quoted_cells(spark, tmp_path):
    text = ',a,"b, ""c""",\r\n"x;y"\r\n\r\n5" pipe, z ,"two\nlines",end\n'
    got = delimited.table(spark, put(tmp_path / "q.csv", text), {"a": 0, "b": 1, "c": 2, "d": 3}, header_tokens=set())
    assert [tuple(r)[:4] for r in got.orderBy("_ord").collect()] == [
        (None, "a", 'b, "c"', None), ("x;y", None, None, None), ('5" pipe', "z", "two\nlines", "end")]


def test_line_breaks_column_orders_and_unbalanced_quotes(spark, tmp_path, caplog):
    put(tmp_path / "d" / "one.csv", 'name;Code;note\nA;1;"first\nsecond; ""x"""\nB;2;\n')
    put(tmp_path / "d" / "two files.csv", '\ufeffCODE;other;NAME\n3;x;C\nCODE;other;NAME\n4;"y\n5;z;E\n')
    put(tmp_path / "d" / "three.csv", "name;code\nÅ;6\n", "cp1252")
    read = lambda: delimited.table(spark, str(tmp_path / "d"), {"name": None, "code": None, "note": None}, ";", fallback="cp1252", required=["name", "code"])
    got = sorted((tuple(r)[:3] for r in read().collect()), key=repr)
    # A row like the header is data; the open quote takes the rest of its file, and the file is named.
    assert ("A", "1", 'first\nsecond; "x"') in got and ("B", "2", None) in got and ("C", "3", None) in got and ("Å", "6", None) in got
    assert ("NAME", "CODE", None) in got and ("E", "5", None) not in got and len(got) == 6
    assert [r.message for r in caplog.records] and "two%20files.csv: unbalanced quotes" in caplog.text
    put(tmp_path / "d" / "four.csv", "name;note\nX;1\n")
    with pytest.raises(GateError):
        read()
    assert delimited.table(spark, put(tmp_path / "e.csv", ""), {"a": 0}, header_tokens=set()).count() == 0


def test_a_large_file_without_line_breaks_in_cells_is_split(spark, tmp_path):
    path = put(tmp_path / "big.csv", "k,v\n" + "".join(f'{i},"a, {i}"\n' for i in range(4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        out = delimited.table(spark, path, {"k": None, "v": None}, required=["k"])
        assert out.rdd.getNumPartitions() > 3 and [r.k for r in out.orderBy("_ord").collect()] == [str(i) for i in range(4000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_every_file_has_its_own_header_and_code_page(spark, tmp_path):
    head, blank = ";".join(registers.NO_COLUMNS), ";" * 9
    long = "".join(f";Ekstra {i:05d}" for i in range(500))  # over 4,096 bytes
    for call, codec, names in (("LA1AA", "utf-8", head), ("LA2BB", "cp1252", head), ("LA3CC", "cp865", head), ("LA4DD", "cp1252", "Nr" + long + ";" + head)):
        row = f"{call};;Kåre;Ås{blank[:-2]}"
        put(tmp_path / "no" / f"{call}.csv", names + "\n" + (";" * 501 if names != head else "") + row + "\n", codec)
    assert rows(registers.read_no(spark, str(tmp_path / "no")), "callsign", "first_name", "last_name") == [
        (c, "Kåre", "Ås") for c in ("LA1AA", "LA2BB", "LA3CC", "LA4DD")]
    lines = base.read_lines(spark, put(tmp_path / "x.txt", b"a\x01b\xe9\r\n \n\n\x01c\n"), "ISO-8859-1")
    assert sorted(r.value for r in lines.collect()) == ["\x01c", "a\x01bé"]
    summit = dict.fromkeys(reference.SUMMIT_COLUMNS, "") | {"AltM": "978", "SummitName": "Peak", "ValidFrom": "01/07/2002"}
    for code, names in (("G/1", reference.SUMMIT_COLUMNS), ("W/2", reference.SUMMIT_COLUMNS[::-1])):
        cells = summit | {"SummitCode": code}
        put(tmp_path / "s" / f"{code[0]}.csv", "SOTA Summits List (Date=18/06/2026)\n" + ",".join(names) + "\n" + ",".join(cells[n] for n in names) + "\n")
    got = rows(reference.read_summits(spark, str(tmp_path / "s"), "2026-06-18"), "reference", "alt_m", "valid_from", order="reference")
    assert got == [("G/1", 978, "2002-07-01"), ("W/2", 978, "2002-07-01")]
