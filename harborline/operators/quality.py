"""Column checks that return their failing rows, and a suite that runs them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.operators.joins import orphans


class ChecksFailed(Exception):
    """Raised with the failing checks when a suite must pass."""


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows. NULLs are not compared."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def references(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose non-NULL value is missing from the parent's key."""
    keys = parent.select(F.col(key).alias(column))
    return orphans(df.where(F.col(column).isNotNull()), keys, column)


def accepted(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Rows whose non-NULL value is not in the list."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def run_checks(suite: dict[str, DataFrame]) -> DataFrame:
    """One row per check: its name and the number of failing rows. All checks run as one job."""
    counted = [
        failing.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check"), "failures")
        for name, failing in suite.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


def require(results: DataFrame) -> None:
    """Fail when any check has failures."""
    failed = results.where(F.col("failures") > 0).collect()  # one row per check at most
    if failed:
        raise ChecksFailed(", ".join(f"{r['check']}: {r['failures']}" for r in failed))


def run_declared(models: dict[str, DataFrame], part_of: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """The declared column checks of the insurance models that are present, as run_checks gives them.

    A model is read once for its columns that must only be there, and once for each key. ``part_of`` names the
    models that are rows of another one, and the condition of those rows: a key that both declare is aggregated
    once, with a count for each.
    """
    parts, part_of = [], {m: o for m, o in (part_of or {}).items() if m in models and o[0] in models}
    for model, columns in DECLARED.items():
        if model not in models:
            continue
        df = models[model]
        own, condition = part_of.get(model, (model, None))
        filled = [c for c, kinds in columns.items() if "not_null" in kinds and "unique" not in kinds]
        if filled:
            counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in filled])
            parts.append(_rows({f"not_null_{model}_{c}": F.col(c) for c in filled}, counted))
        for c in (c for c, kinds in columns.items() if "unique" in kinds):
            if condition is not None and "unique" in DECLARED[own].get(c, ()):
                continue  # counted with the model that it is a part of
            # one aggregation per key tells repeats and, as the group of NULL, missing values
            sharing = {m: cond for m, (of, cond) in part_of.items() if of == model and "unique" in DECLARED[m].get(c, ())}
            counts = {model: F.count(F.lit(1))} | {m: F.count_if(F.expr(cond)) for m, cond in sharing.items()}
            groups = df.groupBy(c).agg(*[n.alias(f"n_{m}") for m, n in counts.items()])
            counted = groups.agg(*[measure for m in counts for measure in (
                F.count_if(F.col(c).isNotNull() & (F.col(f"n_{m}") > 1)).alias(f"repeated_{m}"),
                F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col(f"n_{m}"))), F.lit(0)).alias(f"missing_{m}"),
            )])
            found = {}
            for m in counts:
                found[f"unique_{m}_{c}"] = F.col(f"repeated_{m}")
                if "not_null" in DECLARED[m][c]:
                    found[f"not_null_{m}_{c}"] = F.col(f"missing_{m}")
            parts.append(_rows(found, counted))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _rows(found: dict[str, Column], counted: DataFrame) -> DataFrame:
    """One row per check from the single row of counts."""
    pairs = [F.struct(F.lit(name).alias("check"), n.alias("failures")) for name, n in found.items()]
    return counted.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


# The models that are rows of another one, as the build makes them.
PART_OF = {"int_invoice_paid": ("stg_invoice", "status = 'paid'")}

# Which columns of which models are declared unique or not null.
DECLARED = {
    "stg_policy": {
        "policy_number": ["unique", "not_null"],
        "user_id": ["not_null"],
        "effective_date": ["not_null"],
    },
    "stg_invoice": {"id": ["unique", "not_null"], "policy_number": ["not_null"]},
    "stg_claim": {"id": ["unique", "not_null"], "policy_number": ["not_null"]},
    "int_policy_ranked": {"policy_number": ["unique", "not_null"], "user_id": ["not_null"]},
    "int_invoice_paid": {"id": ["unique", "not_null"], "policy_number": ["not_null"]},
    "mart_policy_denormalized": {"policy_number": ["unique", "not_null"]},
}
