"""Data-quality checks in place of the reference's dbt tests and DDL
constraints.  Each check returns its *failing rows* (a test passes when it
returns none); :func:`report` turns a set of checks into one result table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null_counts(df: DataFrame, cols: Sequence[str], table_name: str) -> DataFrame:
    """NULL count of every column in one pass (Q1): one aggregate row with a
    ``count_if`` per column, unpivoted to (table_name, column_name, n_null)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "column_name", "n_null")
    return long.select(F.lit(table_name).alias("table_name"), "column_name", "n_null")


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once (Q2, Q5); map-side combined."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def non_negative(df: DataFrame, col: str) -> DataFrame:
    """Rows with a negative value (Q3)."""
    return df.filter(F.col(col) < 0)


def bounds(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows outside [lo, hi] (Q4); NULL is not a failure, as in SQL."""
    return df.filter((F.col(col) < F.lit(lo)) | (F.col(col) > F.lit(hi)))


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent (Q6); NULL keys are not orphans."""
    return (child.filter(F.col(child_key).isNotNull())
            # no distinct on the parent: an aggregate between the exchange and the
            # join would keep AQE from splitting a hot key
            .join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti"))


def shared_scan(tables: Mapping[str, DataFrame], unique: Mapping[str, tuple[str, Sequence[str]]] | None = None,
                references: Mapping[str, tuple[str, str, str, str]] | None = None,
                rules: Mapping[str, tuple[str, Column]] | None = None) -> DataFrame:
    """(test_name, failures) of many checks over ``tables``, each of which is read once
    (Q7).  ``unique``: test -> (table, columns), counts keys that occur more than once;
    ``references``: test -> (table, column, parent table, parent column), counts rows
    whose key has no parent (NULL is no orphan); ``rules``: test -> (table, condition
    of a failing row).

    A row gives one key per check that it takes part in, as child or as parent;
    keys are counted in one aggregate, combined on the map side so that a hot key or
    a big child costs its distinct keys, and then folded by test.  Keys are
    compared by their text; types of a reference's two sides should agree."""
    unique, references, rules = unique or {}, references or {}, rules or {}
    width = max([len(cols) for _, cols in unique.values()] + [1])
    no_key = [F.lit(None).cast("string")] * width

    def entry(test: str, keys: Sequence[Column], child: int, parent: int, when: Column | None = None) -> Column:
        key = [*[k.cast("string") for k in keys], *no_key][:width]
        e = F.struct(F.lit(test).alias("test_name"), *[k.alias(f"k{i}") for i, k in enumerate(key)],
                     F.lit(child).cast("long").alias("n"), F.lit(parent).alias("is_parent"))
        return e if when is None else F.when(when, e)

    parts = []
    for name, df in tables.items():
        entries = [entry(t, [F.col(c) for c in cols], 1, 0) for t, (of, cols) in unique.items() if of == name]
        entries += [entry(t, [F.col(c)], 1, 0, F.col(c).isNotNull()) for t, (of, c, _, _) in references.items() if of == name]
        entries += [entry(t, [F.col(c)], 0, 1, F.col(c).isNotNull()) for t, (_, _, of, c) in references.items() if of == name]
        entries += [entry(t, [], 1, 0, cond) for t, (of, cond) in rules.items() if of == name]
        if entries:
            parts.append(df.select(F.inline(F.array(*entries))).filter("test_name is not null"))
    seen = parts[0]
    for p in parts[1:]:
        seen = seen.unionByName(p)
    per_key = seen.groupBy("test_name", *[f"k{i}" for i in range(width)]).agg(F.sum("n").alias("n"), F.max("is_parent").alias("is_parent"))
    kind = F.col("test_name")
    failures = (F.when(kind.isin(list(unique)), (F.col("n") > 1).cast("long"))
                .when(kind.isin(list(rules)), F.col("n")).otherwise(F.when(F.col("is_parent") == 0, F.col("n"))))
    found = per_key.groupBy("test_name").agg(F.sum(F.coalesce(failures, F.lit(0))).alias("failures"))
    names = seen.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, [*unique, *references, *rules]))).alias("test_name"))
    # a test without any row passes; at most one row per test
    return names.join(F.broadcast(found), "test_name", "left").select("test_name", F.coalesce("failures", F.lit(0)).alias("failures"))


def report(checks: Mapping[str, DataFrame], counted: Sequence[DataFrame] = ()) -> DataFrame:
    """(test_name, failures, status) for every check (Q7).  ``checks`` map a
    test name to its failing rows; ``counted`` are frames that already hold
    (test_name, failures) rows, e.g. from :func:`not_null_counts`."""
    parts = [df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("test_name"), "failures")
             for name, df in checks.items()]
    parts += [c.select("test_name", "failures") for c in counted]  # at least one check in all
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))


class DataTestFailure(AssertionError):
    """Raised when a data test of a report failed (the build step fails, as
    a failing test fails the reference's test run)."""


def raise_on_failure(report_df: DataFrame) -> DataFrame:
    """Fail when any test of a :func:`report` failed; otherwise return the
    report.  Only the failing tests' names and counts reach the driver (one
    row per test, bounded by the number of tests)."""
    failed = report_df.filter(F.col("status") == F.lit("fail"))
    if not failed.isEmpty():
        names = [f"{r.test_name}={r.failures}" for r in failed.select("test_name", "failures").collect()]
        raise DataTestFailure("data tests failed: " + ", ".join(sorted(names)))
    return report_df
