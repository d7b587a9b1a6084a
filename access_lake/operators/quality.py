"""Data-quality checks (DQ-1..6). Each check returns its failing rows or
one report row per column; empty / zero = pass."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from access_lake.functions.numeric import count_if
from access_lake.operators.aggregates import duplicate_keys, row_count_not


def check_not_null(df: DataFrame, cols: Sequence[str], model: str = "") -> DataFrame:
    """NULL counts of many columns in one scan (DQ-1): a single global
    aggregate, then unpivoted to one row per column."""
    # over no rows a sum is NULL: that is zero failures
    counts = df.agg(*[F.coalesce(count_if(F.col(c).isNull()), F.lit(0)).alias(c) for c in cols])
    long = counts.unpivot([], list(cols), "column_name", "failures")
    return long.select(F.lit(model).alias("model"), F.lit("not_null").alias("check"),
                       "column_name", F.col("failures").cast("bigint").alias("failures"))


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Non-NULL values present more than once (DQ-2; NULLs are the
    not-null check's business)."""
    return duplicate_keys(df.filter(F.col(col).isNotNull()), col)


def check_accepted(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    """Rows whose value is outside the accepted set; NULL is not a
    failure (DQ-3)."""
    return df.filter(~F.col(col).isin(*list(values)))


def check_row_count(df: DataFrame, n: int, out: str = "row_count") -> DataFrame:
    """One row with the count when it differs from ``n`` (DQ-4): a global
    aggregate with HAVING."""
    return row_count_not(df, n, out)


def check_no_duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys present more than once, with their count ``n`` (DQ-5)."""
    return duplicate_keys(df, key)


def gate_verdict(report: DataFrame) -> DataFrame:
    """One row: checks, failed checks, whether the gate opens, and the
    failed ones by name."""
    failed = F.col("failures") > 0
    name = F.concat(F.col("model"), F.lit("."), F.col("column_name"), F.lit(" "), F.col("check"),
                    F.lit(" ("), F.col("failures").cast("string"), F.lit(")"))
    return report.agg(F.count(F.lit(1)).alias("checks"),
                      F.coalesce(count_if(failed), F.lit(0)).alias("failed"),
                      F.array_join(F.sort_array(F.collect_list(F.when(failed, name))), ", ").alias("failures")
                      ).withColumn("passed", (F.col("failed") == 0) & (F.col("checks") > 0))


def gate(report: DataFrame) -> None:
    """Raise when any check failed, or none ran (DQ-6). The report has one
    row per check, a bounded size, so it is safe to bring to the driver."""
    verdict = gate_verdict(report).first()
    if not verdict.passed:
        raise AssertionError(f"data-quality checks failed: {verdict.failures or 'no check ran'}")


def planned_checks(not_null: Sequence[str] = (), unique: str | None = None,
                   accepted: tuple[str, Sequence[str]] | None = None, no_duplicates: str | None = None,
                   row_count: int | None = None) -> list[tuple[str, str]]:
    """(check, column) of each report row, in the order of the report."""
    out = [("not_null", c) for c in not_null]
    out += [("unique", unique)] if unique else []
    out += [("accepted_values", accepted[0])] if accepted else []
    out += [("no_duplicates", no_duplicates)] if no_duplicates else []
    return out + ([("row_count", "*")] if row_count is not None else [])


def missing_model(spark: SparkSession, model: str, **checks) -> DataFrame:
    """The report of a model that was not built: every check fails."""
    rows = [(model, check, column, 1) for check, column in planned_checks(**checks)]
    return spark.createDataFrame(rows, "model string, check string, column_name string, failures bigint")


def model_report(df: DataFrame, model: str, not_null: Sequence[str] = (), unique: str | None = None,
                 accepted: tuple[str, Sequence[str]] | None = None, no_duplicates: str | None = None,
                 row_count: int | None = None) -> DataFrame:
    """All checks of one model in one pass, one report row per check.

    With a key (``unique`` / ``no_duplicates``) the model is grouped once by
    it: per-key row counts give both duplicate checks, and the per-row
    checks (not-null, accepted values) ride along as partial sums, so the
    model is scanned and shuffled once however many checks it has. Without a
    key a single global aggregate does it.
    """
    key = unique or no_duplicates
    if key:
        summary = summed(key_state(df, key, not_null, accepted), key)
    else:
        summary = df.agg(*_per_row(not_null, accepted), F.count(F.lit(1)).alias("rows"))
    return report_rows(summary, model, not_null, unique, accepted, no_duplicates, row_count)


def _per_row(not_null: Sequence[str], accepted: tuple[str, Sequence[str]] | None) -> list[Column]:
    out = [count_if(F.col(c).isNull()).alias(f"nn{i}") for i, c in enumerate(not_null)]
    if accepted:
        out.append(count_if(~F.col(accepted[0]).isin(*list(accepted[1]))).alias("acc"))
    return out


def key_state(df: DataFrame, key: str, not_null: Sequence[str] = (), accepted: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """The state of all checks of a model, one row per key: its rows ``_n``
    and its failures of each per-row check. States of disjoint loads merge
    by summing per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *_per_row(not_null, accepted))


def summed(state: DataFrame, key: str) -> DataFrame:
    """One row of totals over a key state."""
    many = F.col("_n") > 1
    return state.agg(*[F.sum(c).alias(c) for c in state.columns if c not in (key, "_n")],
                     count_if(F.col(key).isNotNull() & many).alias("uniq"), count_if(many).alias("dups"),
                     F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"))


def report_rows(summary: DataFrame, model: str, not_null: Sequence[str] = (), unique: str | None = None,
                accepted: tuple[str, Sequence[str]] | None = None, no_duplicates: str | None = None,
                row_count: int | None = None) -> DataFrame:
    """The report of a model from its row of totals."""
    found = {"unique": F.col("uniq"), "accepted_values": F.col("acc"), "no_duplicates": F.col("dups"),
             "row_count": F.when(F.col("rows") != (row_count or 0), 1).otherwise(0)}
    entries = planned_checks(not_null, unique, accepted, no_duplicates, row_count)
    structs = [F.struct(F.lit(model).alias("model"), F.lit(chk).alias("check"),
                        F.lit(c).alias("column_name"),
                        F.coalesce(F.col(f"nn{i}") if chk == "not_null" else found[chk],
                                   F.lit(0)).cast("bigint").alias("failures"))
               for i, (chk, c) in enumerate(entries)]
    return summary.select(F.inline(F.array(*structs)))
