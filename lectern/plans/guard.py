"""The guarded SQL path: one read-only statement over approved tables and functions, with a row limit, bound parameters, a
deadline and a log row.

The statement is parsed, never searched as text: the guard walks the plan with its expressions and sub-queries. Plan nodes,
functions and tables are all allow-listed; a name of a common table expression counts only where it is in scope.
"""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession


class Refused(ValueError):
    """A statement that the guard doesn't let through."""


#: Logical plan nodes of a read-only query (fixed values: the parser's class names).
NODES = frozenset(
    "Project Filter Aggregate Join Sort GlobalLimit LocalLimit Offset Distinct Union Except Intersect SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedRelation UnresolvedWith UnresolvedHaving"
    " WithWindowDefinition OneRowRelation UnresolvedInlineTable Pivot Unpivot LateralJoin Expand".split()
)
#: Functions a statement may call (fixed values).
FUNCTIONS = frozenset(
    "abs any array_agg avg bool_and bool_or ceil ceiling coalesce concat concat_ws contains corr count count_if cume_dist current_date date date_add date_diff date_format date_sub date_trunc datediff day dense_rank"
    " element_at endswith every exp extract first first_value floor greatest grouping grouping_id hour if ifnull initcap instr int isnan isnotnull isnull lag last last_day last_value lead least left length like ln log"
    " log10 lower lpad ltrim max max_by mean median min min_by minute mod month months_between mode nth_value ntile nullif nvl percent_rank percentile percentile_approx power quarter rank regexp_extract regexp_replace"
    " replace reverse right round row_number rpad rtrim second sign size some split split_part sqrt startswith stddev stddev_pop stddev_samp std string substr substring sum to_date to_timestamp trim trunc try_add"
    " try_cast try_divide upper var_pop var_samp variance weekofyear when window year and or not".split()
)


def _items(sequence) -> Iterator:
    return (sequence.apply(at) for at in range(sequence.size()))


def _class(node) -> str:
    return node.getClass().getSimpleName()


def _check(plan, scope: frozenset[str], approved: set[str], tables: set[str]) -> None:
    """Refuses what isn't allowed below ``plan``; ``scope`` are the common table expressions that may be named here."""
    kind = _class(plan)
    if kind not in NODES:
        raise Refused(f"not allowed in a query: {kind}")
    if kind == "UnresolvedRelation":
        parts = [str(x).lower() for x in _items(plan.multipartIdentifier())]
        if len(parts) == 1 and parts[0] in scope:
            return
        name = ".".join(parts)
        if name not in approved:
            raise Refused(f"tables not approved: {name}")
        tables.add(name)
        return
    if kind == "UnresolvedWith":
        if plan.allowRecursion():
            raise Refused("recursive queries are not allowed")
        for pair in _items(plan.cteRelations()):
            _check(pair._2(), scope, approved, tables)  # a definition sees the ones before it, never itself
            scope = scope | {str(pair._1()).lower()}
        _check(plan.child(), scope, approved, tables)
        return
    for expression in _items(plan.expressions()):
        _check_expression(expression, scope, approved, tables)
    for child in _items(plan.children()):
        _check(child, scope, approved, tables)


def _check_expression(expression, scope: frozenset[str], approved: set[str], tables: set[str]) -> None:
    kind = _class(expression)
    if kind == "UnresolvedFunction":
        name = ".".join(str(x).lower() for x in _items(expression.nameParts()))
        if name not in FUNCTIONS:
            raise Refused(f"functions not allowed: {name}")
    elif "Generator" in kind or kind in ("CallMethodViaReflection", "PythonUDF", "ScalaUDF"):
        raise Refused(f"not allowed in a query: {kind}")
    if hasattr(expression, "plan") and kind in ("ScalarSubquery", "Exists", "ListQuery", "InSubquery", "LateralSubquery", "ArraySubquery"):
        inner = expression.query() if kind == "InSubquery" else expression
        _check(inner.plan(), scope, approved, tables)
    for child in _items(expression.children()):
        _check_expression(child, scope, approved, tables)


LOG = "statement_id string, caller string, statement_hash string, tables array<string>, status string, reason string, n_rows bigint, planned_ms double, ran_ms double"


@dataclass
class GuardedQuery:
    """A statement that passed: its result with the row limit, and how to run it under a deadline."""

    result: DataFrame
    statement: str
    tables: list[str]
    limit: int
    planned_ms: float
    caller: str | None = None

    def run(self, timeout: float = 60.0) -> tuple[list[Row], Row]:
        """(rows, log row); after ``timeout`` seconds the jobs are cancelled and the status is 'timeout'."""
        context, group = self.result.sparkSession.sparkContext, f"guarded-{uuid.uuid4().hex}"
        began, late = time.time(), threading.Event()

        def stop() -> None:
            late.set()
            context.cancelJobGroup(group)

        timer = threading.Timer(timeout, stop)
        rows, status, reason = [], "ok", None
        context.setJobGroup(group, "guarded statement", interruptOnCancel=True)
        timer.start()
        try:
            rows = self.result.collect()
        except Exception as error:
            status, reason = ("timeout", f"over {timeout:g} s") if late.is_set() else ("failed", type(error).__name__)
        finally:
            timer.cancel()
            context.setLocalProperty("spark.jobGroup.id", None)
        digest = hashlib.sha256(self.statement.encode()).hexdigest()
        return rows, Row(statement_id=group, caller=self.caller, statement_hash=digest, tables=self.tables, status=status, reason=reason, n_rows=len(rows), planned_ms=self.planned_ms, ran_ms=(time.time() - began) * 1000)


def refused_row(statement: str, reason: str, caller: str | None = None) -> Row:
    """The log row of a statement that was refused."""
    return Row(statement_id=f"guarded-{uuid.uuid4().hex}", caller=caller, statement_hash=hashlib.sha256(statement.encode()).hexdigest(), tables=[], status="refused", reason=reason, n_rows=0, planned_ms=0.0, ran_ms=0.0)


def write_log(spark: SparkSession, rows: list[Row], path: str) -> None:
    """Appends log rows (``LOG``) to a table."""
    names = [part.split(" ")[0] for part in LOG.split(", ")]
    spark.createDataFrame([tuple(r[n] for n in names) for r in rows], LOG).coalesce(1).write.mode("append").parquet(path)


def guarded_sql(spark: SparkSession, statement: str, approved: set[str], limit: int = 1000, args: dict | None = None, caller: str | None = None) -> GuardedQuery:
    """Parses first and walks the plan: only SELECT (with common table expressions) over ``approved`` tables (full names) and
    allowed functions; the result has a row limit.

    Parameters go in as ``:name`` markers with ``args``, never by building text.
    """
    began = time.time()
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    except Exception as error:
        raise Refused(f"not a statement: {type(error).__name__}") from None
    tables: set[str] = set()
    _check(plan, frozenset(), {a.lower() for a in approved}, tables)
    result = (spark.sql(statement, args=args) if args else spark.sql(statement)).limit(limit)
    return GuardedQuery(result, statement, sorted(tables), limit, (time.time() - began) * 1000, caller)
