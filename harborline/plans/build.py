"""The layered warehouse build: raw tables to staging, intermediate and mart models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.operators.quality import PART_OF, require, run_declared
from harborline.operators.ranking import rank_policies
from harborline.plans import marts, staging
from harborline.sinks.tables import with_load_time, write_table
from harborline.sinks.versions import current, hold, new_version
from harborline.sources.files import read_raw_csv

# The models and the layer each one belongs to.
LAYERS = {
    "stg_policy": "staging",
    "stg_invoice": "staging",
    "stg_claim": "staging",
    "int_invoice_paid": "intermediate",
    "int_policy_ranked": "intermediate",
    "mart_new_vs_returning_premium": "marts",
    "mart_policy_denormalized": "marts",
    "mart_dashboard_daily": "marts",
    "mart_dashboard_monthly": "marts",
    "mart_dashboard_by_product": "marts",
    "mart_dashboard_rollups": "marts",
}


# The CSV files of the raw layer and the tables they become.
RAW_FILES = {"policy.csv": "raw_policy", "invoice.csv": "raw_invoice", "claim.csv": "raw_claim"}


def land_raw(spark: SparkSession, source: str, base: str) -> list[str]:
    """Refresh the raw tables under ``base`` from the CSV files under ``source``; the names of those refreshed.

    Every column stays text, with the time of the load beside it. A file that is missing is skipped, and
    its table stays as it was.
    """
    done = []
    for file, name in RAW_FILES.items():
        rows = read_raw_csv(spark, source, file)
        if rows is not None:
            write_table(with_load_time(rows), f"{base.rstrip('/')}/raw/{name}")
            done.append(name)
    return done


def raw_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{base.rstrip('/')}/raw/{name}") for name in RAW_FILES.values()}


def build(raw: dict[str, DataFrame], threshold: int = staging.OUTLIER_THRESHOLD) -> dict[str, DataFrame]:
    """Every model as a lazy frame. ``raw`` holds raw_policy, raw_invoice and raw_claim."""
    return _models(
        staging.stg_policy(raw["raw_policy"], threshold), staging.stg_invoice(raw["raw_invoice"], raw["raw_policy"]),
        staging.stg_claim(raw["raw_claim"]),
    )


def _models(policies: DataFrame, invoices: DataFrame, claims: DataFrame) -> dict[str, DataFrame]:
    days = marts.daily(policies, invoices, claims)
    return {
        "stg_policy": policies,
        "stg_invoice": invoices,
        "stg_claim": claims,
        "int_invoice_paid": staging.paid(invoices),
        "int_policy_ranked": rank_policies(policies),
        "mart_new_vs_returning_premium": marts.new_vs_returning(invoices, marts.new_policies(policies)),
        "mart_policy_denormalized": marts.policy_wide(policies, invoices, claims),
        "mart_dashboard_daily": days,
        "mart_dashboard_monthly": marts.monthly(policies, invoices, claims),
        "mart_dashboard_by_product": marts.by_product(policies, invoices, claims),
        "mart_dashboard_rollups": marts.rollups(days),
    }


def publish(
    spark: SparkSession, raw: dict[str, DataFrame], base: str, threshold: int = staging.OUTLIER_THRESHOLD,
    check: bool = True,
) -> dict[str, DataFrame]:
    """Stage once, check, write the marts, and only then let readers of ``base`` see any of it; all models as read.

    Typed staging tables are written before anything reads them, so raw tables are read and cast once. The
    declared checks run on staging, the intermediate models and the wide mart before the first mart is written.
    Every build has a version folder of its own (``harborline.sinks.versions``), which becomes the one that
    ``published`` gives when it is complete: a failing check or write leaves all tables of the last build.
    """
    version, folder = new_version(base)

    def stored(name: str, df: DataFrame) -> DataFrame:
        path = f"{folder}/{LAYERS[name]}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    policies = stored("stg_policy", staging.stg_policy(raw["raw_policy"], threshold))
    invoices = stored("stg_invoice", staging.stg_invoice(raw["raw_invoice"], policies, mostly_known=True))
    claims = stored("stg_claim", staging.stg_claim(raw["raw_claim"]))
    models = _models(policies, invoices, claims)
    if check:
        require(run_declared(models, PART_OF))
    models["mart_dashboard_daily"] = stored("mart_dashboard_daily", models["mart_dashboard_daily"])
    models["mart_dashboard_rollups"] = marts.rollups(models["mart_dashboard_daily"])
    for name, layer in LAYERS.items():
        if layer == "marts" and name != "mart_dashboard_daily":
            models[name] = stored(name, models[name])
    hold(spark, base, version)
    return models


def published(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The staging tables and marts of the last complete build under ``base``."""
    folder = current(spark, base)
    written = {n: layer for n, layer in LAYERS.items() if layer != "intermediate"}
    return {name: spark.read.parquet(f"{folder}/{layer}/{name}") for name, layer in written.items()}


def model_rows(models: dict[str, DataFrame]) -> DataFrame:
    """One row per model with its row count."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("model"), "row_count")
        for name, df in models.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
