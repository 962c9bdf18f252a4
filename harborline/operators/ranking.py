"""Order of a user's policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

# NULL dates sort last; id only settles rows that repeat a policy number.
ORDER_COLUMNS = ["effective_date", "policy_number", "id"]

#: A user's day with more policies than this is cut into slots, each of so many policy numbers.
BUSY_DAY, SLOT = 100_000, 1 << 16


def _before(counts: DataFrame, by: list[str], order: list[Column], name: str) -> Column:
    """The rows of all groups of ``counts`` (``_n`` each) that come before a group."""
    earlier = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(name)


def _met(rows: DataFrame, groups: DataFrame, keys: dict[str, str]) -> DataFrame:
    """``rows`` with the columns of their group, NULL meeting NULL; the group's key columns go."""
    same = F.lit(True)
    for own, other in keys.items():
        same &= rows[own].eqNullSafe(groups[other])
    return rows.join(groups, same).drop(*keys.values())


def rank_policies(policies: DataFrame) -> DataFrame:
    """Add policy_rank (1 = the user's first policy by effective date) and is_new_policy.

    A rank is the user's policies of earlier days plus the place inside the day. Days are counted before
    they are ordered, so the window over a user holds a row per day and the window over rows holds a
    user's single day: no task gets all policies of a user, however many there are.

    A day of over ``BUSY_DAY`` policies (NULL dates are one day) is counted once more in the same way: by exact time
    and by ranges of ``SLOT`` policy numbers, if these are whole numbers. Such days are told by the counts that are
    there anyway; without one that branch has no rows.
    """
    whole = isinstance(policies.schema["policy_number"].dataType, IntegralType)
    placed = policies.withColumns({
        "_day": F.to_date("effective_date"), "_slot": F.floor(F.col("policy_number") / SLOT) if whole else F.lit(0)})
    per_day = placed.groupBy(F.col("user_id").alias("_user"), F.col("_day").alias("_on")).agg(F.count(F.lit(1)).alias("_n"))
    days = per_day.select("_user", "_on", "_n", _before(per_day, ["_user"], [F.asc_nulls_last("_on")], "_before"))
    of_day = {"user_id": "_user", "_day": "_on"}
    order = [F.asc_nulls_last(c) for c in ORDER_COLUMNS]

    plain = _met(placed, days.where(F.col("_n") <= BUSY_DAY).drop("_n"), of_day)
    plain = plain.withColumn("_place", F.col("_before") + F.row_number().over(Window.partitionBy("user_id", "_day").orderBy(*order)))

    busy = _met(placed, days.where(F.col("_n") > BUSY_DAY).drop("_n"), of_day)
    cut = ["user_id", "_day", "effective_date", "_slot"]
    names = {c: f"_of_{c}" for c in cut}
    per_slot = busy.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(F.count(F.lit(1)).alias("_n"))
    slot_order = [F.asc_nulls_last(names["effective_date"]), F.asc_nulls_last(names["_slot"])]
    slots = per_slot.select(*names.values(), _before(per_slot, [names["user_id"], names["_day"]], slot_order, "_in_day"))
    busy = _met(busy, slots, names)
    here = F.row_number().over(Window.partitionBy(*cut).orderBy(*order))
    busy = busy.withColumn("_place", F.col("_before") + F.col("_in_day") + here)

    columns = [*policies.columns, F.col("_place").cast("int").alias("policy_rank"), (F.col("_place") == 1).alias("is_new_policy")]
    return plain.select(*columns).unionByName(busy.select(*columns))
