"""Driver tables and the derived "dirty registry" input.

The driver tables carry no nulls and no stray whitespace, so most quality
operators would be vacuous on them.  ``dirty_registry`` derives a messy
10-column registry from ``customer`` x ``nation`` x ``region``; it grows
with the customer table.  The same SQL text runs in DuckDB (the oracle),
with the ``{customer}``/``{nation}``/``{region}`` placeholders replaced by
plain table names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


DIRTY_SQL = """
select
  concat(lpad(cast(c.c_nationkey as string),2,'0'),'-',lpad(cast(c.c_custkey % 40 as string),2,'0'),'-',lpad(cast(c.c_custkey % 10000 as string),4,'0'),'-',case when c.c_custkey % 97 = 0 then 'X6' else '46' end) as code,
  case when c.c_custkey % 23 = 0 then null when c.c_custkey % 3 = 0 then concat(lpad(cast(c.c_nationkey as string),2,'0'),'-',lpad(cast(c.c_custkey % 40 as string),3,'0')) else concat(lpad(cast(c.c_nationkey as string),2,'0'),'-',lpad(cast(c.c_custkey % 40 as string),2,'0'),'-',lpad(cast(c.c_custkey % 10000 as string),4,'0')) end as district,
  case when r.r_name = 'ASIA' and c.c_custkey % 2 = 0 then 'ASIA CAPITAL' else r.r_name end as department,
  case when c.c_custkey % 9 = 0 then concat('ZONA ', cast(c.c_custkey % 25 as string)) else n.n_name end as municipality,
  case when c.c_custkey % 301 = 0 then null else concat('ESCUELA ', n.n_name, ' ', cast(c.c_custkey % 7 as string)) end as name,
  case when c.c_custkey % 151 = 0 then null when c.c_custkey % 149 = 0 then ',,' when c.c_custkey % 139 = 0 then 's/d' else concat(cast(c.c_custkey % 12 as string), ' AVENIDA  ', c.c_mktsegment) end as address,
  case when c.c_custkey % 13 = 0 then null when c.c_custkey % 41 = 0 then concat('2220', cast(c.c_custkey % 10 as string), '-1723') when c.c_custkey % 83 = 0 then 'TEL 5565' else lpad(cast(20000000 + c.c_custkey as string),8,'0') end as phone,
  case when c.c_custkey % 19 = 0 then null when c.c_custkey % 211 = 0 then '-------- ---' when c.c_custkey % 61 = 0 then 'EDNA ACEVED0' when c.c_custkey % 31 = 0 then ' ANA  LOPEZ ' else concat('SUPERVISOR ', n.n_name) end as supervisor,
  case when c.c_custkey % 7 = 0 then null when c.c_custkey % 29 = 0 then '---' when c.c_custkey % 37 = 0 then '0' when c.c_custkey % 43 = 0 then 'SIN DATO' when c.c_custkey % 53 = 0 then concat('P', '�', 'REZ') else concat('DIR ', c.c_mktsegment) end as director,
  case when c.c_custkey % 5 = 0 then 'Privado' when c.c_custkey % 11 = 0 then 'PRIVADO' when c.c_custkey % 17 = 0 then 'MUNICIPÁL' when c.c_custkey % 3 = 0 then 'MUNICIPAL' else 'OFICIAL' end as sector
from {customer} c join {nation} n on c.c_nationkey = n.n_nationkey join {region} r on n.n_regionkey = r.r_regionkey
"""

# The 17 columns of the original export, derived from the dirty registry {dirty}.
REGISTRY_SQL = """
select code as CODIGO, district as DISTRITO, department as DEPARTAMENTO, municipality as MUNICIPIO,
  name as ESTABLECIMIENTO, address as DIRECCION, phone as TELEFONO, supervisor as SUPERVISOR, director as DIRECTOR,
  'DIVERSIFICADO' as NIVEL, sector as SECTOR, case when k % 3 = 0 then 'RURAL' else 'URBANA' end as AREA,
  case when k % 17 = 0 then 'CERRADA' else 'ABIERTA' end as STATUS, 'MONOLINGUE' as MODALIDAD,
  case when k % 2 = 0 then 'MATUTINA' else 'VESPERTINA' end as JORNADA, 'DIARIO(REGULAR)' as PLAN,
  concat(department, ' NORTE') as DEPARTAMENTAL
from (select *, cast(substr(code, 7, 4) as int) as k from ({dirty}) d) e
"""
REGISTRY_COLUMNS = ("CODIGO", "DISTRITO", "DEPARTAMENTO", "MUNICIPIO", "ESTABLECIMIENTO", "DIRECCION", "TELEFONO",
                    "SUPERVISOR", "DIRECTOR", "NIVEL", "SECTOR", "AREA", "STATUS", "MODALIDAD", "JORNADA", "PLAN",
                    "DEPARTAMENTAL")

DIRTY_COLUMNS = ("code", "district", "department", "municipality", "name", "address",
                 "phone", "supervisor", "director", "sector")


def dirty_sql_for_duckdb() -> str:
    return DIRTY_SQL.format(customer="customer", nation="nation", region="region")


def dirty_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messy registry view derived from customer, nation and region.

    A row group of a file is one task, whatever the rows in it become; the
    customers are dealt to all tasks before they are widened.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return spark.sql(DIRTY_SQL,
                     customer=customer.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))),
                     nation=table(spark, sf_dir, "nation"),
                     region=table(spark, sf_dir, "region"))


def full_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 17-column registry export derived from the dirty registry."""
    return spark.sql(REGISTRY_SQL.replace("({dirty})", "{dirty}"), dirty=dirty_registry(spark, sf_dir))


def department_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue of valid departments for the dirty registry: region names."""
    return table(spark, sf_dir, "region").select("r_name").withColumnRenamed("r_name", "value")


@dataclass(frozen=True)
class Roles:
    """Which column plays which part of the registry.

    Defaults follow the dirty registry; ``Roles.registry()`` gives the names of
    the original 18-column export.
    """
    key: str = "code"
    district: str = "district"
    department: str = "department"
    municipality: str = "municipality"
    name: str = "name"
    address: str = "address"
    phone: str = "phone"
    supervisor: str = "supervisor"
    director: str = "director"
    sector: str | None = "sector"
    level: str | None = None
    status: str | None = None
    area: str | None = None
    regional_office: str | None = None
    origin: str = "origin"

    @staticmethod
    def registry() -> "Roles":
        return Roles(key="CODIGO", district="DISTRITO", department="DEPARTAMENTO",
                     municipality="MUNICIPIO", name="ESTABLECIMIENTO", address="DIRECCION",
                     phone="TELEFONO", supervisor="SUPERVISOR", director="DIRECTOR",
                     sector="SECTOR", level="NIVEL", status="STATUS", area="AREA",
                     regional_office="DEPARTAMENTAL", origin="origen")


DIRTY_ROLES = Roles()


def read_registry_csv(spark: SparkSession, path: str, na_strings=None, sep: str = ",") -> DataFrame:
    """Read a united registry CSV: header, every column a string, the CSV
    reader's default missing tokens (empty, ``NA``, ``NULL``, ...) -> null.

    A missing path raises ``FileNotFoundError`` naming the steps to run first.
    """
    from pyspark.errors import AnalysisException
    from pyspark.sql import functions as F

    from dqspark.functions import constants as K
    tokens = list(na_strings if na_strings is not None else K.PANDAS_NA_STRINGS)
    try:
        df = (spark.read.option("header", True).option("sep", sep).option("multiLine", True)
              .option("escape", '"').csv(path))
        cols = df.columns
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"{path} not found; run the ingest and union steps first") from e
        raise
    return df.select([F.when(F.col(c).isin(tokens), None).otherwise(F.col(c)).alias(c) for c in cols])
