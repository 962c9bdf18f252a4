"""Guarded ad-hoc SQL: one read-only statement, a bounded answer."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

MAX_ROWS = 200

# Words that may not occur in an ad-hoc query, and the words it may begin with.
FORBIDDEN = [
    "INSERT", "UPDATE", "DELETE", "DROP", "TRUNCATE", "ALTER", "CREATE", "GRANT", "REVOKE", "COPY", "CALL", "EXECUTE",
]
OPENERS = ["SELECT", "WITH"]
# Functions that call Java code by name.
REFLECTION = ["JAVA_METHOD", "REFLECT", "TRY_REFLECT"]


class Refused(ValueError):
    """The statement is not allowed; the message says why."""


def check(text: str) -> str:
    """The statement without its closing semicolons, or Refused with the reason.

    The word list also refuses harmless text, such as a forbidden word inside a string literal.
    """
    statement = text.strip()
    if not statement:
        raise Refused("empty")
    statement = statement.rstrip(";").rstrip()
    if ";" in statement:
        raise Refused("chained")
    if not statement.upper().startswith(tuple(OPENERS)):
        raise Refused("not a query")
    found = set(re.findall(r"\w+", statement.upper())) & set(FORBIDDEN + REFLECTION)
    if found:
        raise Refused(f"forbidden word: {', '.join(sorted(found))}")
    return statement


def _leaves(plan):
    """The plan's nodes down to views, subqueries in expressions included, which Scala hands out one by one."""
    kind = plan.getClass().getSimpleName()
    yield kind, plan
    if kind == "View":
        return
    inner = plan.children()
    for i in range(inner.size()):
        yield from _leaves(inner.apply(i))
    nested = plan.subqueries()
    for i in range(nested.size()):
        yield from _leaves(nested.apply(i))
    if kind == "WithCTE":
        defined = plan.cteDefs()
        for i in range(defined.size()):
            yield from _leaves(defined.apply(i))


#: Leaves that read no data of their own.
HARMLESS = {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef", "View"}


def _read_only_views(plan, views: Sequence[str] | None) -> None:
    allowed = None if views is None else {v.lower() for v in views}
    for kind, node in _leaves(plan):
        if kind == "View":
            name = node.desc().identifier().table().lower()
            if allowed is not None and name not in allowed:
                raise Refused(f"not one of the views: {name}")
        elif node.children().isEmpty() and kind not in HARMLESS:
            raise Refused(f"reads something that is no view: {kind}")


def _own_limit(plan) -> bool:
    """Whether the outermost operator, below renaming, is a limit."""
    while plan.getClass().getSimpleName() in ("Project", "SubqueryAlias", "WithCTE"):
        plan = plan.plan() if plan.getClass().getSimpleName() == "WithCTE" else plan.child()
    return plan.getClass().getSimpleName() == "GlobalLimit"


def readonly_sql(
    spark: SparkSession, text: str, max_rows: int | None = MAX_ROWS, views: Sequence[str] | None = None
) -> DataFrame:
    """Run one SELECT over registered views, or only over ``views``.

    A statement whose outermost operator is a limit keeps it; any other answer is limited to ``max_rows``
    (None: not at all). The word list does not understand SQL, so the statement is also used as a subquery,
    where Spark accepts only a query, and the analysed plan decides: it may read views and nothing else, so
    no files by path and no tables. Functions that call Java code by name are among the refused words.
    """
    statement = check(text)
    try:
        query = spark.sql(f"SELECT * FROM (\n{statement}\n)")
    except PySparkException as error:
        raise Refused(f"not a valid query: {error.getCondition()}") from error
    plan = query._jdf.queryExecution().analyzed()
    _read_only_views(plan, views)
    if max_rows is None or _own_limit(plan):
        return query
    return query.limit(max_rows)


def verdict(text: str) -> str:
    try:
        check(text)
    except Refused as reason:
        return str(reason)
    return "ok"
