"""Raw export files: encodings, header search, footers, broken files."""

import pytest

from dqspark.sources import ingest

HEADER = "CODIGO;;DISTRITO;DEPARTAMENTO;MUNICIPIO;ESTABLECIMIENTO;DIRECCION;TELEFONO;NIVEL;SECTOR"
ROW = "01-01-0001-01;;01-001;GUATEMALA;MIXCO;ESCUELA É;CALLE 1;22334455;PRIMARIA;OFICIAL"


@pytest.fixture
def landing(tmp_path):
    def make(spark, files):
        for name, content in files.items():
            (tmp_path / name).write_bytes(content)
        return ingest.read_landing(spark, str(tmp_path))
    return make


def test_ledger_covers_good_and_broken_files(spark, landing):
    good = "\r\n".join(["junk", "", HEADER, ROW, "Total;1"]).encode("cp1252")
    bom = ("﻿" + "\n".join([HEADER, ROW.replace("É", "E"), ROW.replace("0001", "0002")])).encode("utf-8")
    files = {
        "a.csv": good,
        "b.csv": bom,
        "c.csv": "no header here\nCODIGO;X\n".encode("utf-8"),
        "d.csv": "\n".join([HEADER, ROW + ";extra"]).encode("utf-8"),
        "e.csv": b"\x81\x8d nothing",
        "empty.csv": b"",
        "latin.csv": "\n".join([HEADER, ROW.replace("0001", "0009") + "\x81"]).encode("latin-1"),
        "f.csv": "\n".join([HEADER.replace("CODIGO;", "CODE;CODIGO_DISTRITO ESTABLECIMIENTO;"), ROW]).encode("utf-8"),
    }
    ing = ingest.ingest(landing(spark, files))
    led = {r.origin: r for r in ing.ledger.collect()}
    assert led["a.csv"].encoding == "cp1252"
    assert (led["a.csv"].lines_before, led["a.csv"].rows_from_header, led["a.csv"].rows_removed,
            led["a.csv"].rows_kept) == (2, 2, 1, 1)
    assert led["a.csv"].unnamed_dropped == "Unnamed: 1"
    assert led["a.csv"].status == "Correcto" and led["a.csv"].output_file == "a_new.csv"
    assert led["b.csv"].encoding == "utf-8-sig" and led["b.csv"].rows_kept == 2
    assert led["c.csv"].status.startswith("Error")
    assert led["d.csv"].status == "Error: Expected 10 fields in line 2, saw 11"
    assert led["e.csv"].status.startswith("Error: could not decode")
    assert led["empty.csv"].status.startswith("Error: could not decode")
    assert led["latin.csv"].encoding == "latin-1"
    assert led["f.csv"].status.startswith("Error")
    united = ingest.strict_union(ing)
    assert united.count() == 4
    assert {r.ESTABLECIMIENTO for r in united.collect()} == {"ESCUELA É", "ESCUELA E"}


def test_strict_union_rejects_other_structure(spark, landing):
    other = "\n".join([HEADER + ";EXTRA", ROW + ";1"]).encode("utf-8")
    ing = ingest.ingest(landing(spark, {"a.csv": "\n".join([HEADER, ROW]).encode("utf-8"), "b.csv": other}))
    try:
        ingest.strict_union(ing)
    except ValueError as e:
        assert "b.csv" in str(e)
    else:
        raise AssertionError("expected a structure error")


def test_read_landing_from_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\n".join([HEADER, ROW]).encode("cp1252"))
    (tmp_path / "skip.txt").write_bytes(b"CODIGO")
    df = ingest.read_landing(spark, str(tmp_path))
    assert df.files.count() == 1
    assert ingest.ingest(df).rows.count() == 1
    with pytest.raises(FileNotFoundError):
        ingest.read_landing(spark, str(tmp_path), "*.none")


def test_file_larger_than_a_split(spark, tmp_path):
    """One file in many splits: header, order, counts and records come out as from one piece."""
    lines = ["junk;"] * 50 + [HEADER]
    for i in range(20000):
        row = ROW.replace("0001", f"{i % 10000:04d}").replace("É", "Á€")
        lines.append(row.replace("CALLE 1", '"CALLE\n1"') if i % 500 == 7 else row)
    (tmp_path / "big.csv").write_bytes("\r\n".join([*lines, "Total;1"]).encode("cp1252"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        land = ingest.read_landing(spark, str(tmp_path))
        assert land.lines.rdd.getNumPartitions() > 10
        ing = ingest.ingest(land)
        led = ing.ledger.first()
        assert (led.encoding, led.lines_before, led.rows_from_header, led.rows_removed, led.rows_kept, led.status) == \
            ("cp1252", 50, 20001, 1, 20000, "Correcto")
        united = ingest.strict_union(ing)
        assert united.where("ESTABLECIMIENTO = 'ESCUELA Á€'").count() == 20000
        assert united.where("DIRECCION = 'CALLE\n1'").count() == 40
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_cells(spark):
    rows = ['a;b', ';;', '"x;y";z', '"a ""q"" b";', ' p ;"', '']
    got = spark.createDataFrame([(r,) for r in rows], "line string").select(ingest.cells("line")).collect()
    assert [r[0] for r in got] == [["a", "b"], [None] * 3, ["x;y", "z"], ['a "q" b', None], [" p ", '"'], [None]]


def test_read_registry_csv_nulls_tokens_and_missing_path(spark, tmp_path):
    from dqspark.sources.tables import read_registry_csv
    p = tmp_path / "u.csv"
    p.write_text("A,B\nNA,x\n,N/A\ns/d, y \n", encoding="utf-8-sig")
    rows = read_registry_csv(spark, str(p)).collect()
    assert [tuple(r) for r in rows] == [(None, "x"), (None, None), ("s/d", " y ")]
    with pytest.raises(FileNotFoundError):
        read_registry_csv(spark, str(tmp_path / "missing.csv"))


def test_file_review_missing_columns(spark):
    rows = spark.createDataFrame([("a.csv", " X ", "M1"), ("a.csv", "X", "M2"), ("b.csv", "X", None)],
                                 "origen string, DEPARTAMENTO string, MUNICIPIO string")
    got = {r.file: r for r in ingest.file_review(rows, "origen", "DEPARTAMENTO", "MUNICIPIO", 2).collect()}
    assert (got["a.csv"].departments, got["a.csv"].municipalities, got["a.csv"].status) == (1, 2, "Correcto")
    values = {tuple(r) for r in ingest.file_values(rows, "origen", "DEPARTAMENTO", "MUNICIPIO").collect()}
    assert ("a.csv", "DEPARTAMENTO", "X", 2) in values and len(values) == 4
    no_mun = {r.file: r for r in ingest.file_review(rows.drop("MUNICIPIO"), "origen", "DEPARTAMENTO",
                                                       "MUNICIPIO", 1).collect()}
    assert no_mun["b.csv"].municipalities == 0
    no_dep = {r.file: r for r in ingest.file_review(rows.drop("DEPARTAMENTO"), "origen", "DEPARTAMENTO",
                                                       "MUNICIPIO", 1).collect()}
    assert no_dep["a.csv"].status == "column DEPARTAMENTO missing"


def test_quoted_cell_spanning_lines(spark, landing):
    body = "\n".join([HEADER, ROW.replace("CALLE 1", '"CALLE 1\nFRENTE AL PARQUE; ZONA 2"'),
                      ROW.replace("0001", "0002"), "Total;2"])
    ing = ingest.ingest(landing(spark, {"q.csv": body.encode("utf-8")}))
    led = ing.ledger.first()
    assert (led.status, led.rows_from_header, led.rows_kept) == ("Correcto", 3, 2)
    got = sorted(r.DIRECCION for r in ingest.strict_union(ing).collect())
    assert got == ["CALLE 1", "CALLE 1\nFRENTE AL PARQUE; ZONA 2"]


def test_repeated_header_names_are_renamed(spark, landing):
    header = HEADER + ";SECTOR;SECTOR"
    body = "\n".join([header, ROW + ";X;Y"]).encode("utf-8")
    ing = ingest.ingest(landing(spark, {"d.csv": body}))
    cols = ing.columns.first().columns
    assert cols[-3:] == ["SECTOR", "SECTOR.1", "SECTOR.2"]
    row = ing.rows.first().data
    assert (row["SECTOR"], row["SECTOR.1"], row["SECTOR.2"]) == ("OFICIAL", "X", "Y")
