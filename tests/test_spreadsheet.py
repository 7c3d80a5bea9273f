"""Spreadsheet XML and JSON items in several files."""

import pytest
from pyspark.sql import functions as F

from regweave.operators.guards import GateError
from regweave.sources import base, spreadsheet

HEAD = '<?xml version="1.0"?>\n<Workbook xmlns="urn:schemas-microsoft-com:office:spreadsheet" xmlns:ss="urn:schemas-microsoft-com:office:spreadsheet">'


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def row(*cells):
    out = ""
    for i, c in enumerate(cells, 1):
        out += "" if c is None else f'<Cell ss:Index="{i}"><ss:Data ss:Type="String">{c}</ss:Data></Cell>'
    return f"<Row>{out}</Row>"


def sheet(*rows, name="Sheet1"):
    return f'<Worksheet ss:Name="{name}"><Table>\n' + "\n".join(rows) + "\n</Table></Worksheet>"


def read(spark, path):
    out = spreadsheet.by_titles(spreadsheet.spreadsheet_rows(spark, path), {"name": "name", "code": "code"})
    return sorted((tuple(r)[:2] for r in out.collect()), key=repr)


def test_files_with_headers_of_their_own(spark, tmp_path):
    put(tmp_path / "a b.xml", HEAD + sheet(row("Nr", "Full NAME", None, "Code"), row("1", "A &lt;x&gt;", "z", "c1"), "<Row/>", row(None, None, None, "c2")) + "</Workbook>")
    put(tmp_path / "two.xml", HEAD + "<Worksheet><Table>" + row("CODE", "name") + row("c3", "B <B>bold</B> é") + "</Table></Worksheet></Workbook>")
    put(tmp_path / "three.xml", HEAD + sheet(row("code", "name"), row("c4", "D")) + sheet(row("other"), row("x"), name="Sheet2") + "</Workbook>")
    # Text that looks like a tag is text; a header text found twice takes the first column.
    assert read(spark, str(tmp_path)) == sorted([("A <x>", "c1"), (None, None), (None, "c2"), ("B bold é", "c3"), ("D", "c4")], key=repr)


def test_refused_and_broken_files(spark, tmp_path):
    good = HEAD + sheet(row("name", "code"), row("a", "b")) + "</Workbook>"
    for i, (text, error) in enumerate([
        ("<!DOCTYPE x>" + good, GateError), (HEAD + "</Workbook>", GateError), (HEAD + sheet(row("name")) + "</Workbook>", GateError), (HEAD + sheet() + "</Workbook>", GateError),
        (HEAD + sheet(row("name", "code"), "<Row><Cell><Data>x</Cell></Row>") + "</Workbook>", Exception),
    ]):
        put(tmp_path / str(i) / "ok.xml", good)
        with pytest.raises(error):
            read(spark, put(tmp_path / str(i) / "bad.xml", text).replace("bad.xml", ""))
    assert read(spark, str(tmp_path / "0" / "ok.xml")) == [("a", "b")]


def test_a_large_sheet_of_lines_is_split(spark, tmp_path):
    path = put(tmp_path / "big.xml", HEAD + "\n" + sheet(row("name", "code"), *[row(f"n{i}", i) for i in range(3000)]) + "</Workbook>")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        assert spreadsheet.spreadsheet_rows(spark, path).rdd.getNumPartitions() > 3
        assert read(spark, path) == sorted((f"n{i}", str(i)) for i in range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_json_items_of_lines_arrays_and_pretty_files(spark, tmp_path):
    put(tmp_path / "j" / "a_X.json", '[{"a": 1, "b": "x,]"},\n {"a": 2},\n\n{"b": "{"}\n]\n')
    put(tmp_path / "j" / "b_Y.json", '﻿[{"a": 3, "b": "q"},\n{"a": 4}]')
    put(tmp_path / "j" / "c_Z.json", '{"a": 5}\n{"a": 6}\n')
    put(tmp_path / "j" / "d_E.json", "[]")
    got = [(r.a, r.b, r.file) for r in base.json_items(spark, str(tmp_path / "j"), "a int, b string").orderBy("_ord").collect()]
    assert got == [(1, "x,]", "a_X.json"), (2, None, "a_X.json"), (None, "{", "a_X.json"), (3, "q", "b_Y.json"), (4, None, "b_Y.json"), (5, None, "c_Z.json"), (6, None, "c_Z.json")]
    assert base.json_items(spark, str(tmp_path / "j" / "d_E.json"), "a int").count() == 0
    with pytest.raises(Exception):
        base.json_items(spark, put(tmp_path / "bad.json", '{"a": nope}\n'), "a int").select(F.sum("a")).collect()
