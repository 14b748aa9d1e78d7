"""Raw export folder -> every output of the registry flow."""

from dqspark.plans.registry_flow import process_registry

HEADER = ("CODIGO;;DISTRITO;DEPARTAMENTO;MUNICIPIO;ESTABLECIMIENTO;DIRECCION;TELEFONO;SUPERVISOR;DIRECTOR;"
          "NIVEL;SECTOR;AREA;STATUS;MODALIDAD;JORNADA;PLAN;DEPARTAMENTAL;;")


def line(code, dep, mun, name, addr, phone, sup, director, jornada="MATUTINA"):
    return (f"{code};;16-001;{dep};{mun};{name};{addr};{phone};{sup};{director};DIVERSIFICADO;PRIVADO;URBANA;"
            f"ABIERTA;MONOLINGUE;{jornada};DIARIO(REGULAR);GUATEMALA NORTE;;")


def test_process_registry(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    junk = ["Listado de establecimientos", ""] * 13
    f1 = junk + [HEADER,
                 line("16-01-0001-46", "CIUDAD CAPITAL", "ZONA 1", "COLEGIO MIXTO", "5 CALLE JOSÉ", "22334455", "JUAN", "ANA"),
                 line("16-01-0002-46", "GUATEMALA", "ZONA 1", "MIXTO COLEGIO", "5 CALLE JOSÉ", "2220-1723", "JUAN", "ANA"),
                 "Total;2", "", "Pagina 1"]
    f2 = junk + [HEADER,
                 line("17-01-0003-46", "PETÉN", "FLORES", "ESCUELA", "BARRIO", "", "EDNA ACEVED0", "---"),
                 "Total;1"]
    (land / "establecimiento (1).csv").write_bytes("\r\n".join(f1).encode("cp1252"))
    (land / "establecimiento (2).csv").write_bytes(("﻿" + "\n".join(f2)).encode("utf-8"))
    out = process_registry(spark, str(land), str(tmp_path / "out"))
    led = {r.origin: r for r in out["ingest_ledger"].collect()}
    assert led["establecimiento (1).csv"].encoding == "cp1252"
    assert led["establecimiento (1).csv"].lines_before == 26
    assert led["establecimiento (1).csv"].rows_kept == 2 and led["establecimiento (1).csv"].rows_removed == 2
    assert led["establecimiento (1).csv"].output_file == "establecimiento_1_new.csv"
    assert led["establecimiento (2).csv"].encoding == "utf-8-sig"
    assert out["cleaned"].count() == 3
    review = {r.file: r.status for r in out["file_review"].collect()}
    assert review["establecimiento (1).csv"] == "Revisar"      # CIUDAD CAPITAL and GUATEMALA
    assert out["candidate_duplicates"].count() == 1
    q = {r.metric: (r.before, r.after) for r in out["quality_report"].collect()}
    assert q["rows"] == ("3", "3") and q["possible duplicates"] == ("0", "1")
    assert all(r.ok for r in out["validations"].collect() if r.ord in (2, 3, 5, 8))
