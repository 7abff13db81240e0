"""Profiling queries."""

from __future__ import annotations

from catalog.fixtures import COLUMN_LIST, sql
from catalog.registry import query, rounded
from tablewright.fixed_values import RAW_COLUMNS
from tablewright.operators import clean, profile


def per_column(template: str, columns: list[str] = RAW_COLUMNS) -> str:
    return " UNION ALL ".join(template.replace("{c}", c) for c in columns)


MISSING = per_column(
    "SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count,"
    " round((count(*) - count({c})) * CAST(100 AS DOUBLE) / count(*), 2) AS missing_pct FROM dirty")
FENCES = ("quantile_cont({c}, 0.25) - 1.5e0 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
          " AS lo, quantile_cont({c}, 0.75) + 1.5e0 * (quantile_cont({c}, 0.75)"
          " - quantile_cont({c}, 0.25)) AS hi")


def outliers_sql(table: str) -> str:
    return per_column(
        "SELECT '{c}' AS column_name, CAST(count(*) FILTER ({c} < lo OR {c} > hi) AS BIGINT)"
        " AS outlier_count, round(count(*) FILTER ({c} < lo OR {c} > hi) * CAST(100 AS DOUBLE)"
        f" / count(*), 2) AS outlier_pct FROM {table}, (SELECT {FENCES} FROM {table})")


def totals_sql(table: str) -> str:
    nulls = " + ".join(f"(count(*) - count({c}))" for c in RAW_COLUMNS)
    return (f"SELECT count(*) AS total_rows, CAST({len(RAW_COLUMNS)} AS BIGINT) AS total_columns,"
            f" CAST({nulls} AS BIGINT) AS missing_cells, CAST(count(*) - (SELECT count(*) FROM"
            f" (SELECT DISTINCT {COLUMN_LIST} FROM {table})) AS BIGINT) AS duplicate_rows"
            f" FROM {table}")


@query("q_counts", sql("SELECT count(*) AS total_rows, CAST(9 AS BIGINT) AS total_columns"
                       " FROM dirty", "dirty"))
def _(t):
    return profile.counts(t.dirty())


@query("q_dups", sql(f"SELECT duplicate_rows FROM ({totals_sql('dirty')})", "dirty"))
def _(t):
    return profile.duplicate_count(t.dirty())


@query("q_missing", sql(MISSING, "dirty"))
def _(t):
    return profile.missing(t.dirty())


@query("q_missing_table", sql(f"SELECT * FROM ({MISSING}) WHERE missing_count > 0", "dirty"))
def _(t):
    return profile.missing_table(t.dirty())


@query("q_outlier_profile", sql(outliers_sql("dirty"), "dirty"))
def _(t):
    return profile.outliers(t.dirty())


@query("q_describe", sql(per_column(
    "SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean,"
    " round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,"
    " round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,"
    " round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM dirty"), "dirty"))
def _(t):
    return rounded(profile.describe(t.dirty()), 4)


@query("q_totals", sql(totals_sql("dirty"), "dirty"))
def _(t):
    return profile.totals(t.dirty())


@query("q_info", sql(per_column(
    "SELECT '{c}' AS column_name, count({c}) AS non_null, 'double' AS data_type FROM dirty"),
    "dirty"))
def _(t):
    return profile.column_info(t.dirty())


@query("q_head", sql(f"SELECT row_key, {COLUMN_LIST} FROM listings ORDER BY row_key LIMIT 10",
                     "listings"))
def _(t):
    return profile.head(t.listings(key=True), ["row_key"], 10)


MEANS = ("SELECT " + ", ".join(f"coalesce({c}, (SELECT avg({c}) FROM dirty)) AS {c}"
                               for c in RAW_COLUMNS) + " FROM dirty")


def quality_sql(table: str, phase: str) -> str:
    whole = " UNION ALL ".join(
        f"SELECT CAST(NULL AS VARCHAR) AS column_name, '{m}' AS metric, CAST({m} AS DOUBLE) AS"
        f" value FROM ({totals_sql(table)})"
        for m in ("total_rows", "total_columns", "missing_cells", "duplicate_rows"))
    cols = " UNION ALL ".join(
        f"SELECT column_name, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM ({q})"
        for q, ms in ((MISSING.replace("FROM dirty", f"FROM {table}"),
                       ("missing_count", "missing_pct")),
                      (outliers_sql(table), ("outlier_count", "outlier_pct"))) for m in ms)
    return f"SELECT *, '{phase}' AS phase FROM ({whole} UNION ALL {cols})"


@query("q_profile_pair", sql(
    f"{quality_sql('dirty', 'before')} UNION ALL {quality_sql('cleaned', 'after')}", "dirty",
    extra={"cleaned": f"SELECT DISTINCT * FROM ({MEANS})"}))
def _(t):
    dirty = t.dirty()
    return profile.before_after(dirty, clean.dedup(clean.impute(dirty, "mean")))
