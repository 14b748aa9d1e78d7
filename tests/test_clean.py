from dqspark.operators import clean
from dqspark.sources.tables import Roles
from tests.conftest import SF_SMALL


SCHEMA = ("code string, district string, department string, municipality string, name string, "
          "address string, phone string, supervisor string, director string, sector string")


def test_rules_and_audit_counts(spark):
    rows = [
        ("01-01-0001-01", "01", "CIUDAD CAPITAL", "ZONA 1", "ESC", ",,", " 22334455", "ACEVED0", None, "s/d"),
        ("01-01-0002-01", "01", "GUATEMALA", "zona 10", None, "CALLE  1", "22334455", None, "---", "OFICIAL"),
        ("01-01-0003-01", "01", "GUATEMALA", "MIXCO", "ESC", "x", None, "-", "0", "N/A"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    c = clean.Cleaning(df, clean.CleanConfig(roles=Roles()))
    out = {r.code: r for r in c.cleaned.collect()}
    assert out["01-01-0001-01"].department == "GUATEMALA"
    assert out["01-01-0001-01"].municipality == "GUATEMALA"
    assert out["01-01-0001-01"].phone == "DESCONOCIDO"          # no strip before the phone rule
    assert out["01-01-0001-01"].supervisor == "ACEVEDO"
    assert out["01-01-0001-01"].address == "DESCONOCIDO"
    assert out["01-01-0001-01"].sector == "DESCONOCIDO"
    assert out["01-01-0002-01"].address == "CALLE 1"
    assert out["01-01-0002-01"].name == "DESCONOCIDO"
    assert out["01-01-0003-01"].supervisor == "DESCONOCIDO"
    audit = {(r.step, r.variable): r.affected for r in c.audit().collect()}
    assert audit[(1, "director")] == 3
    assert audit[(2, "phone")] == 2
    assert audit[(3, "supervisor")] == 2          # typo + junk; the filled null is not counted
    assert audit[(4, "municipality")] == 2
    assert audit[(5, "department")] == 1
    assert audit[(10, "all text columns")] == 1


def test_clean_is_idempotent_and_keeps_rows(spark):
    from dqspark.sources.tables import dirty_registry
    d = dirty_registry(spark, SF_SMALL)
    once = clean.Cleaning(d).cleaned
    twice = clean.Cleaning(once).cleaned
    assert once.count() == d.count()
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_errors_corrected_equals_audit_sum(spark):
    from dqspark.sources.tables import dirty_registry
    c = clean.Cleaning(dirty_registry(spark, SF_SMALL))
    assert c.errors_corrected().first()[0] == clean.errors_corrected(c.audit()).first()[0]


def test_observed_counts_equal_aggregate(spark, tmp_path):
    from dqspark.sources.tables import dirty_registry
    d = dirty_registry(spark, SF_SMALL)
    plain = clean.Cleaning(d).counts().first().asDict()
    c = clean.Cleaning(d)
    c.materialize(str(tmp_path / "m"))
    assert c.counts().first().asDict() == plain
    assert c.errors_corrected().first()[0] == clean.errors_corrected(clean.Cleaning(d).audit()).first()[0]


def test_phone_strip_first_option(spark):
    df = spark.createDataFrame([("01-01-0001-01", " 22334455")], "code string, phone string")
    cfg = clean.CleanConfig(roles=Roles(), document_district=False)
    keep = clean.rule_changes(df, "phone", cfg).count()
    cfg2 = clean.CleanConfig(roles=Roles(), document_district=False, phone_strip_first=True)
    assert keep == 1 and clean.rule_changes(df, "phone", cfg2).count() == 0
