"""Declarative data tests with severities, and the gate that enforces them.

Row-level tests on one table (not_null, accepted_values, expressions,
conditional nulls) are evaluated together in a single aggregate pass and
unpivoted into result rows; ``unique`` is one grouped count per column and
``relationships`` one anti-join per column. The result is a small DataFrame
(one row per test); ``gate`` collects it -- bounded by the number of tests --
and raises when an ``error`` test failed, so a failing test stops the stage
while ``warn`` only reports.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.columns import count_where

ERROR = "error"
WARN = "warn"
RESULT_COLUMNS = ["test", "col", "severity", "failures"]


class DataTestFailure(RuntimeError):
    def __init__(self, failed: list[dict]):
        self.failed = failed
        names = ", ".join(f"{f['test']}({f['col']})={f['failures']}" for f in failed)
        super().__init__(f"data tests failed: {names}")


@dataclass
class DataTest:
    kind: str
    column: str
    severity: str = ERROR
    values: tuple = ()
    parent: DataFrame | None = None
    parent_column: str | None = None
    predicate: Column | None = None
    name: str | None = None
    extra: dict = field(default_factory=dict)

    @property
    def label(self) -> str:
        return self.name or self.kind


def not_null(column: str, severity: str = ERROR) -> DataTest:
    return DataTest("not_null", column, severity)


def unique(column: str, severity: str = ERROR) -> DataTest:
    """Failures = number of values seen more than once; nulls are ignored."""
    return DataTest("unique", column, severity)


def accepted_values(column: str, values: Iterable[str], severity: str = ERROR) -> DataTest:
    """Failures = non-null values outside the set (null passes)."""
    return DataTest("accepted_values", column, severity, values=tuple(values))


def relationships(column: str, parent: DataFrame, parent_column: str,
                  severity: str = ERROR) -> DataTest:
    """Failures = non-null child keys with no parent row."""
    return DataTest("relationships", column, severity, parent=parent, parent_column=parent_column)


def expression(name: str, column: str, failing_row: Column, severity: str = ERROR) -> DataTest:
    """Failures = rows where ``failing_row`` is true."""
    return DataTest("expression", column, severity, predicate=failing_row, name=name)


def conditional_null(column: str, present_when: Column, severity: str = ERROR) -> list[DataTest]:
    """``column`` must be set exactly when ``present_when`` holds: two tests,
    one for rows missing it, one for rows leaking it."""
    cond = F.coalesce(present_when, F.lit(False))
    return [
        expression("conditional_missing", column, cond & F.col(column).isNull(), severity),
        expression("conditional_leaked", column, ~cond & F.col(column).isNotNull(), severity),
    ]


def _row_failure(t: DataTest) -> Column:
    c = F.col(t.column)
    if t.kind == "not_null":
        return c.isNull()
    if t.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(t.values))
    if t.kind == "expression":
        return F.coalesce(t.predicate, F.lit(False))
    raise ValueError(t.kind)


def _result(test: str, col: str, severity: str, failures: Column) -> list[Column]:
    return [F.lit(test).alias("test"), F.lit(col).alias("col"), F.lit(severity).alias("severity"),
            failures.cast("bigint").alias("failures")]


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    repeated = (df.filter(F.col(column).isNotNull()).groupBy(column)
                .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1))
    return repeated.agg(F.count(F.lit(1)).alias("failures"))


def relationship_failures(child: DataFrame, column: str, parent: DataFrame,
                          parent_column: str) -> DataFrame:
    """Count of child rows whose non-null key is absent from the parent.

    Child rows are counted per key first, so a hot key is one row by the time
    it is joined; then the counts of the keys without a parent are summed. The
    join is an outer one, because the optimizer would push an anti join below
    the counting. The parent side is left to AQE, which broadcasts it at
    runtime only when its measured size is under the broadcast threshold.
    """
    keys = (child.select(F.col(column).alias("_k")).filter(F.col("_k").isNotNull())
            .groupBy("_k").agg(F.count(F.lit(1)).alias("_n")))
    parents = parent.select(F.col(parent_column).alias("_k")).distinct().withColumn("_hit", F.lit(1))
    orphans = keys.join(parents, "_k", "left").filter(F.col("_hit").isNull())
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))


def conditional_null_counts(df: DataFrame, column: str, present_when: Column) -> DataFrame:
    """One row: rows missing ``column`` where required, rows carrying it where not."""
    cond = F.coalesce(present_when, F.lit(False))
    return df.agg(
        count_where(cond & F.col(column).isNull()).alias("missing"),
        count_where(~cond & F.col(column).isNotNull()).alias("leaked"),
    )


def run_tests(df: DataFrame, tests: Sequence[DataTest]) -> DataFrame:
    """Evaluate tests against ``df``; one result row per test."""
    parts: list[DataFrame] = []
    row_tests = [t for t in tests if t.kind in ("not_null", "accepted_values", "expression")]
    if row_tests:
        counts = df.agg(*[count_where(_row_failure(t)).alias(f"_t{i}") for i, t in enumerate(row_tests)])
        rows = F.array(*[
            F.struct(*_result(t.label, t.column, t.severity, F.col(f"_t{i}")))
            for i, t in enumerate(row_tests)
        ])
        parts.append(counts.select(F.explode(rows).alias("_r")).select("_r.*"))
    for t in tests:
        if t.kind == "unique":
            parts.append(unique_failures(df, t.column)
                         .select(*_result(t.label, t.column, t.severity, F.col("failures"))))
        elif t.kind == "relationships":
            parts.append(relationship_failures(df, t.column, t.parent, t.parent_column)
                         .select(*_result(t.label, t.column, t.severity, F.col("failures"))))
    if not parts:
        raise ValueError("no tests given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate(results: DataFrame) -> list[dict]:
    """Raise ``DataTestFailure`` if an error-severity test failed; return warnings."""
    rows = [r.asDict() for r in results.collect()]
    failed = [r for r in rows if r["failures"] and r["severity"] == ERROR]
    if failed:
        raise DataTestFailure(failed)
    return [r for r in rows if r["failures"]]
