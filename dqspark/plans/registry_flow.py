"""The whole registry flow: raw export folder -> trusted table and reports.

``process_registry`` runs, as Spark jobs, what the original did step by step:
ingest the raw files (ledger), unite them strictly with lineage (union
ledger, per-file review), diagnose, clean with an audit log, look for fuzzy
duplicate candidates before and after, compare quality and validate.  Every
output is written under ``out_dir`` (Parquet, the cleaned table also as a
verified CSV); large intermediates are written once and read back.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from dqspark.functions import constants as K
from dqspark.operators import clean, dedupe
from dqspark.plans import diagnosis
from dqspark.sources import ingest
from dqspark.sources.sinks import export_verified
from dqspark.sources.tables import Roles


@dataclass
class RegistryConfig:
    roles: Roles = field(default_factory=Roles.registry)
    department_catalog: object = K.DEPARTMENTS
    clean: clean.CleanConfig | None = None
    fuzzy: dedupe.FuzzyConfig | None = None
    sep: str = ";"

    def clean_config(self) -> clean.CleanConfig:
        return self.clean or clean.CleanConfig(roles=self.roles, no_issue_columns=clean.NO_ISSUE_REGISTRY)

    def fuzzy_config(self) -> dedupe.FuzzyConfig:
        r = self.roles
        return self.fuzzy or dedupe.FuzzyConfig(
            key=r.key, name=r.name, address=r.address, blocks=(r.department, r.municipality),
            differentiators=tuple(c for c in ("JORNADA", "MODALIDAD", "PLAN", r.director, r.status) if c))


def process_registry(spark: SparkSession, landing: str | ingest.Landing, out_dir: str,
                     config: RegistryConfig | None = None) -> dict[str, DataFrame]:
    """Run the flow on a landing folder (or an ``ingest.Landing``); the outputs by name."""
    cfg = config or RegistryConfig()
    r = cfg.roles
    out = out_dir.rstrip("/")

    if isinstance(landing, str):
        landing = ingest.read_landing(spark, landing)
    ing = ingest.ingest(landing, sep=cfg.sep, key=r.key)
    ing = ing.materialize(f"{out}/ingest")
    united = ingest.strict_union(ing, origin_column=r.origin)
    united.write.mode("overwrite").parquet(f"{out}/united")
    united = spark.read.parquet(f"{out}/united")
    data_cols = len(united.columns) - 1

    results: dict[str, DataFrame] = {
        "ingest_ledger": ing.ledger,
        "union_ledger": ingest.union_ledger(ing),
        "file_review": ingest.file_review(united, r.origin, r.department, r.municipality, data_cols),
        "file_values": ingest.file_values(united, r.origin, r.department, r.municipality),
    }
    before = diagnosis.Diagnosis(united, r, department_catalog=cfg.department_catalog)
    results["diagnosis"] = before.tidy_report()

    cleaning = clean.Cleaning(united, cfg.clean_config())
    cleaned = cleaning.materialize(f"{out}/clean")
    export_verified(cleaned, f"{out}/cleaned_csv", fmt="csv")
    results["transformation_log"] = cleaning.audit()

    fz = cfg.fuzzy_config()
    results["candidate_duplicates"] = dedupe.fuzzy_pairs(cleaned, fz)
    results["duplicate_members"] = dedupe.fuzzy_members(cleaned, fz)
    after = diagnosis.Diagnosis(cleaned, r, department_catalog=cfg.department_catalog)
    results["quality_report"] = diagnosis.before_after(
        before.quality_metrics(dedupe.fuzzy_pairs_count(united, fz)),
        after.quality_metrics(dedupe.fuzzy_pairs_count(cleaned, fz), cleaning.errors_corrected()))
    results["validation_values"] = diagnosis.validation_values(cleaned, r, cfg.department_catalog)
    results["validations"] = diagnosis.validate(cleaned, r, cfg.department_catalog,
                                                aliases=cfg.clean_config().aliases)
    for name, df in results.items():
        if name != "ingest_ledger":
            df.write.mode("overwrite").parquet(f"{out}/{name}")
        results[name] = spark.read.parquet(f"{out}/{name}") if name != "ingest_ledger" else df
    results["cleaned"] = cleaned
    return results
