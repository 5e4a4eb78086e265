"""Declarative data-quality checks (Q1-Q13).

A suite is a list of ``Check`` values.  ``run_checks`` turns every row-level
and table-level check into aggregate expressions of **one** ``agg`` (one scan,
partial aggregates per task), then unpivots that single wide row into the
report.  Uniqueness needs a grouping: all ``unique`` checks of a table share
one, over (column, value) with a count for each check.  A ``View`` shows some
rows of a table under other names; its checks run in the passes over that
table.  The report is a small DataFrame; only a gate collects it (at most one
row per check).

Report columns: check_id, check, column, evaluated, unexpected, observed,
success, severity.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import half_away
from ..schemas import PRODUCT_CODES, QUALITY_COLUMNS

REPORT_COLUMNS = ["check_id", "check", "column", "evaluated", "unexpected", "observed",
                  "success", "severity"]


@dataclass(frozen=True)
class Check:
    kind: str                      # see KINDS
    column: str | None = None
    args: dict = field(default_factory=dict)
    severity: str = "error"        # "error" fails a gate, "warn" only reports


@dataclass(frozen=True)
class View:
    """A model that shows the rows ``where`` of the model ``of``; ``columns``
    gives the column of ``of`` behind each of its names."""
    of: str
    where: Column
    columns: dict


KINDS = ("row_count_between", "columns_superset", "in_set", "not_in_set", "not_null",
         "mean_between", "between", "unique")


def _lit_or_null(v, typ: str) -> Column:
    return F.lit(None).cast(typ) if v is None else F.lit(v).cast(typ)


def _outside(c: Column, lo, hi, strict_min: bool, strict_max: bool) -> Column:
    conds = []
    if lo is not None:
        conds.append(c <= F.lit(lo) if strict_min else c < F.lit(lo))
    if hi is not None:
        conds.append(c >= F.lit(hi) if strict_max else c > F.lit(hi))
    out = F.lit(False)
    for cond in conds:
        out = out | cond
    return out


def _row(i: int, chk: Check, evaluated: Column, unexpected: Column, observed: Column,
         success: Column) -> Column:
    return F.struct(F.lit(i).alias("check_id"), F.lit(chk.kind).alias("check"),
                    _lit_or_null(chk.column, "string").alias("column"),
                    evaluated.cast("long").alias("evaluated"),
                    unexpected.cast("long").alias("unexpected"),
                    observed.cast("double").alias("observed"),
                    success.alias("success"), F.lit(chk.severity).alias("severity"))


def _compile(i: int, chk: Check, df_columns: list[str], view: View | None = None, prefix: str = "q"):
    """(aggregate expressions, report-row expression over those aggregates)."""
    a, p = chk.args, f"__{prefix}{i}_"
    null_l, null_d = F.lit(None).cast("long"), F.lit(None).cast("double")

    def shown(x: Column) -> Column:
        return x if view is None else F.when(view.where, x)

    def count_of(cond: Column) -> Column:
        return F.count_if(cond if view is None else cond & view.where)

    if chk.kind == "columns_superset":
        missing = [c for c in a["columns"] if c not in (df_columns if view is None else view.columns)]
        return [], _row(i, chk, F.lit(len(a["columns"])), F.lit(len(missing)), null_d,
                        F.lit(not missing))
    if chk.kind == "row_count_between":
        n = F.col(p + "n")
        ok = F.lit(True)
        if a.get("min") is not None:
            ok = ok & (n >= a["min"])
        if a.get("max") is not None:
            ok = ok & (n <= a["max"])
        return [F.count(shown(F.lit(1))).alias(p + "n")], _row(i, chk, n, null_l, n, ok)
    c = F.col(_base_column(chk, view))
    if chk.kind == "mean_between":
        m = F.col(p + "m")
        if a.get("percent_digits") is not None:  # compare the rounded percentage
            pct = half_away(m * F.lit(100.0), a["percent_digits"])
            ok = (pct >= a["min"] * 100) & (pct <= a["max"] * 100)
        else:
            ok = (m >= a["min"]) & (m <= a["max"])
        return ([F.count(shown(c)).alias(p + "e"), F.avg(shown(c)).alias(p + "m")],
                _row(i, chk, F.col(p + "e"), null_l, half_away(m, 6), F.coalesce(ok, F.lit(False))))
    if chk.kind == "not_null":
        aggs = [F.count(shown(F.lit(1))).alias(p + "e"), count_of(c.isNull()).alias(p + "u")]
    elif chk.kind == "in_set":
        aggs = [F.count(shown(c)).alias(p + "e"), count_of(~c.isin(*a["values"])).alias(p + "u")]
    elif chk.kind == "not_in_set":
        aggs = [F.count(shown(c)).alias(p + "e"), count_of(c.isin(*a["values"])).alias(p + "u")]
    elif chk.kind == "between":
        bad = _outside(c, a.get("min"), a.get("max"), a.get("strict_min", False),
                       a.get("strict_max", False))
        aggs = [F.count(shown(c)).alias(p + "e"), count_of(c.isNotNull() & bad).alias(p + "u")]
    else:
        raise ValueError(f"unknown check kind {chk.kind!r}")
    u = F.col(p + "u")
    return aggs, _row(i, chk, F.col(p + "e"), u, null_d, u == 0)


def _base_column(chk: Check, view: View | None) -> str:
    return chk.column if view is None else view.columns[chk.column]


def _unique_report(df: DataFrame, tests: list[tuple[str, int, Check, View | None]]) -> DataFrame:
    """Distinct non-null values that occur more than once (NULLs ignored).

    One shuffle for all tests: rows are counted by (column, value), combined
    map-side, with one counter for each test of that column; tests of the same
    column share its rows."""
    columns = sorted({_base_column(chk, view) for _, _, chk, view in tests})
    shown = [F.lit(True) if view is None else F.coalesce(view.where, F.lit(False)) for _, _, _, view in tests]
    flags = [flag.alias(f"s{k}") for k, flag in enumerate(shown)]
    if len(columns) == 1:
        pairs = df.select(F.lit(0).alias("c"), F.col(columns[0]).alias("v"), *flags)
    else:
        pairs = df.select(F.explode(F.array(*[F.struct(F.lit(j).alias("c"), F.col(c).cast("string").alias("v"))
                                              for j, c in enumerate(columns)])).alias("p"), *flags)
        pairs = pairs.select("p.c", "p.v", *[f"s{k}" for k in range(len(tests))])
    counts = pairs.where(F.col("v").isNotNull()).groupBy("c", "v").agg(*[
        F.count_if((F.col("c") == columns.index(_base_column(chk, view))) & F.col(f"s{k}")).alias(f"n{k}")
        for k, (_, _, chk, view) in enumerate(tests)])
    agg = counts.agg(*[F.sum(f"n{k}").alias(f"e{k}") for k in range(len(tests))],
                     *[F.count_if(F.col(f"n{k}") > 1).alias(f"u{k}") for k in range(len(tests))])
    rows = [_named(model, _row(i, chk, F.coalesce(F.col(f"e{k}"), F.lit(0)), F.col(f"u{k}"),
                               F.lit(None).cast("double"), F.col(f"u{k}") == 0))
            for k, (model, i, chk, _) in enumerate(tests)]
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.row.*", "r.model")


def _named(model: str, row: Column) -> Column:
    return F.struct(row.alias("row"), F.lit(model).alias("model"))


def _report(df: DataFrame, models: list[tuple[str, View | None, list[Check]]]) -> DataFrame:
    """The report of all ``models`` over the rows of ``df``: one aggregate for
    the row and table checks, one grouping for the uniqueness checks."""
    aggs, rows, uniques = [], [], []
    for m, (model, view, checks) in enumerate(models):
        for i, chk in enumerate(checks, start=1):
            if chk.kind == "unique":
                uniques.append((model, i, chk, view))
                continue
            a, r = _compile(i, chk, df.columns, view, f"q{m}_")
            aggs += a
            rows.append(_named(model, r))
    parts = []
    if rows:
        base = df.agg(*aggs) if aggs else df.sparkSession.range(1)
        parts.append(base.select(F.explode(F.array(*rows)).alias("r")).select("r.row.*", "r.model"))
    if uniques:
        parts.append(_unique_report(df, uniques))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Evaluate ``checks`` on ``df``; returns the report (one row per check)."""
    return _report(df, [("", None, checks)]).drop("model")


def summarize(report: DataFrame) -> DataFrame:
    """Total, passed, failed and percent passed, and whether all passed (Q7)."""
    return report.agg(
        F.count(F.lit(1)).alias("total_expectations"),
        F.count_if(F.col("success")).alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("failed_expectations"),
    ).withColumn("success_percent",
                 half_away(F.col("successful_expectations") * F.lit(100.0)
                           / F.col("total_expectations"), 2)
                 ).withColumn("validation_success", F.col("failed_expectations") == 0)


def failed_checks(report: DataFrame, severity: str = "error") -> DataFrame:
    return report.where(~F.col("success") & (F.col("severity") == severity))


class QualityGateError(ValueError):
    pass


def gate(report: DataFrame) -> DataFrame:
    """Raise ``QualityGateError`` listing failed error-level checks (Q8).

    Collects only the failed report rows (bounded by the suite size).
    """
    failed = failed_checks(report).orderBy("check_id").collect()
    if failed:
        names = ", ".join(f"{r['check']}({r['column'] or 'table'})" for r in failed)
        raise QualityGateError(f"{len(failed)} data-quality checks failed: {names}")
    return report


# ---------------------------------------------------------------------------
# Suites.  Thresholds that depend on the data size are parameters.
# ---------------------------------------------------------------------------

def staging_suite(min_rows: int = 500_000, max_rows: int = 700_000,
                  min_fraud_mean: float = 0.01, max_fraud_mean: float = 0.10) -> list[Check]:
    """The 16 checks of the validation stage (Q1-Q7)."""
    # Columns and bounds of the stage's checks.
    return [
        Check("row_count_between", None, {"min": min_rows, "max": max_rows}),
        Check("columns_superset", None, {"columns": list(QUALITY_COLUMNS)}),
        Check("in_set", "isFraud", {"values": [0, 1]}),
        Check("not_null", "isFraud"),
        Check("mean_between", "isFraud", {"min": min_fraud_mean, "max": max_fraud_mean}),
        Check("not_null", "TransactionAmt"),
        Check("not_null", "log_TransactionAmt"),
        Check("between", "log_TransactionAmt", {"min": 0}),
        Check("in_set", "ProductCD", {"values": list(PRODUCT_CODES)}),
        Check("not_null", "P_emaildomain"),
        Check("between", "tx_hour", {"min": 0, "max": 23}),
        Check("between", "tx_day_of_week", {"min": 0, "max": 6}),
        Check("in_set", "is_night_tx", {"values": [0, 1]}),
        Check("in_set", "is_large_tx", {"values": [0, 1]}),
        Check("in_set", "has_identity", {"values": [0, 1]}),
        Check("between", "card1_tx_count", {"min": 0}),
    ]


def soft_load_checks(min_rows: int = 500_000, min_rate: float = 0.03,
                     max_rate: float = 0.04) -> list[Check]:
    """Post-load checks that only warn (Q13)."""
    return [
        Check("row_count_between", None, {"min": min_rows}, severity="warn"),
        Check("mean_between", "isFraud", {"min": min_rate, "max": max_rate, "percent_digits": 2}, severity="warn"),
        Check("not_in_set", "TransactionAmt", {"values": [-999]}, severity="warn"),
    ]


# Schema tests per model (Q9-Q12).
SOURCE_TESTS = [
    Check("unique", "TransactionID"), Check("not_null", "TransactionID"),
    Check("not_null", "isFraud"), Check("in_set", "isFraud", {"values": [0, 1]}),
    Check("not_null", "TransactionAmt"), Check("not_null", "tx_hour"),
    Check("in_set", "has_identity", {"values": [0, 1]}),
]
STG_TESTS = [
    Check("unique", "transaction_id"), Check("not_null", "transaction_id"),
    Check("not_null", "is_fraud"), Check("in_set", "is_fraud", {"values": [0, 1]}),
    Check("not_null", "tx_hour"), Check("not_null", "transaction_amt"),
]
SUMMARY_TESTS = [Check("not_null", "card1"), Check("not_null", "fraud_rate_pct")]
HOURLY_TESTS = [Check("unique", "tx_hour"), Check("not_null", "tx_hour")]


def schema_tests(models: dict[str, tuple[DataFrame | View, list[Check]]]) -> DataFrame:
    """Run each model's tests and stack the reports with a ``model`` column (Q12).

    A table and the views of it are tested together: one pass for the row and
    table tests of all of them, one shuffle for their uniqueness tests."""
    out = None
    for name, (df, checks) in models.items():
        if isinstance(df, View) and df.of in models:
            continue  # with its table
        if isinstance(df, View):
            raise ValueError(f"{name} is a view of {df.of}, which is not among the models")
        views = [(n, v, c) for n, (v, c) in models.items() if isinstance(v, View) and v.of == name]
        rep = _report(df, [(name, None, checks), *views])
        out = rep if out is None else out.unionByName(rep)
    return out
