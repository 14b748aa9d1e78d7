"""The library on the original 18-column registry layout (not the dirty view)."""

from pyspark.sql import functions as F

from dqspark.functions import constants as K
from dqspark.operators import clean, dedupe
from dqspark.plans import diagnosis
from dqspark.sources.tables import Roles

COLS = ["CODIGO", "DISTRITO", "DEPARTAMENTO", "MUNICIPIO", "ESTABLECIMIENTO", "DIRECCION", "TELEFONO",
        "SUPERVISOR", "DIRECTOR", "NIVEL", "SECTOR", "AREA", "STATUS", "MODALIDAD", "JORNADA", "PLAN",
        "DEPARTAMENTAL", "origen"]


def rows():
    base = ["16-01-0001-46", "16-001", "CIUDAD CAPITAL", "ZONA 1", "COLEGIO MIXTO", "5 CALLE 2-10 ZONA 1",
            "22334455", "JUAN PEREZ", "ANA LOPEZ", "DIVERSIFICADO", "PRIVADO", "URBANA", "ABIERTA",
            "MONOLINGUE", "MATUTINA", "DIARIO(REGULAR)", "GUATEMALA NORTE", "establecimiento (1).csv"]
    out = [list(base)]
    r = list(base); r[0] = "16-01-0002-46"; r[4] = "MIXTO COLEGIO"; r[6] = "2220-1723"
    out.append(r)
    r = list(base); r[0] = "16-01-0003-46"; r[2] = "GUATEMALA"; r[3] = "MIXCO"; r[7] = "EDNA ACEVED0"
    r[8] = "---"; r[10] = "Privado"; out.append(r)
    r = list(base); r[0] = "16-01-0004-46"; r[6] = None; r[8] = "0"; r[14] = "VESPERTINA"; out.append(r)
    return [tuple(x) for x in out]


def test_full_flow_on_registry_columns(spark):
    df = spark.createDataFrame(rows(), ", ".join(f"`{c}` string" for c in COLS))
    roles = Roles.registry()
    diag = diagnosis.Diagnosis(df, roles, department_catalog=K.DEPARTMENTS)
    tidy = {(r.section, r.variable, r.metric): r.value for r in diag.tidy_report().collect()}
    assert tidy[("a_shape", "", "rows")] == "4" and tidy[("a_shape", "", "columns")] == "18"
    assert tidy[("f_domain", "DEPARTAMENTO", "invalid_value")] == "CIUDAD CAPITAL"
    assert tidy[("f_domain", "NIVEL", "invalid_values")] == "0"
    assert tidy[("f_variants", "SECTOR", "groups")] == "1"
    cfg = clean.CleanConfig(roles=roles, no_issue_columns=("CODIGO",))
    c = clean.Cleaning(df, cfg)
    cleaned = {r.CODIGO: r for r in c.cleaned.collect()}
    assert cleaned["16-01-0001-46"].DEPARTAMENTO == "GUATEMALA"
    assert cleaned["16-01-0001-46"].MUNICIPIO == "GUATEMALA"
    assert cleaned["16-01-0002-46"].TELEFONO == "DESCONOCIDO"
    assert cleaned["16-01-0003-46"].SUPERVISOR == "EDNA ACEVEDO"
    assert cleaned["16-01-0003-46"].DIRECTOR == "DESCONOCIDO"
    audit = c.audit().collect()
    assert audit[0].variable == "DIRECTOR" and audit[0].affected == 2
    checks = {r.ord: r.ok for r in diagnosis.validate(c.cleaned, roles, K.DEPARTMENTS).collect()}
    assert checks[4] and checks[5] and checks[8]
    fz = dedupe.FuzzyConfig(key="CODIGO", name="ESTABLECIMIENTO", address="DIRECCION",
                            blocks=("DEPARTAMENTO", "MUNICIPIO"),
                            differentiators=("JORNADA", "MODALIDAD", "PLAN", "DIRECTOR", "STATUS"))
    pairs = dedupe.fuzzy_pairs(c.cleaned, fz).collect()
    # same tokens in another order, same block and differentiators; row 3
    # moved block, row 4 has another JORNADA
    assert [(p.rows_1, p.pairs, p.similarity) for p in pairs] == [(2, 1, 100.0)]
    members = dedupe.fuzzy_members(c.cleaned, fz).where(F.col("text") == pairs[0].text_1)
    assert {"16-01-0001-46", "16-01-0002-46"} <= {m.CODIGO for m in members.collect()}
