"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import COLUMN_LIST, sql
from catalog.profile_queries import MEANS, outliers_sql
from catalog.registry import query, rounded
from tablewright.fixed_values import RAW_COLUMNS
from tablewright.operators import clean, scale
from tablewright.plans import jobs
from tablewright.session import stage

FEATURES = [c for c in RAW_COLUMNS if c != "price"]


def select_list(template: str, columns: list[str] = RAW_COLUMNS) -> str:
    return ", ".join(template.replace("{c}", c) for c in columns)


@query("c_drop_rows", sql(f"SELECT {COLUMN_LIST} FROM dirty WHERE "
                          + " AND ".join(f"{c} IS NOT NULL" for c in RAW_COLUMNS), "dirty"))
def _(t):
    return clean.drop_rows(t.dirty())


@query("c_drop_cols", sql(
    "SELECT row_key, price, CASE WHEN row_key % 100 < 48 THEN NULL ELSE age END AS half"
    " FROM listings", "listings"))
def _(t):
    # nearly half of one column is missing, so it stays; most of the other
    wide = t.listings(key=True).selectExpr(
        "row_key", "price", "CASE WHEN row_key % 100 < 48 THEN NULL ELSE age END AS half",
        "CASE WHEN row_key % 10 < 7 THEN NULL ELSE grade END AS mostly")
    return clean.drop_sparse_columns(wide)


@query("c_mean", sql(f"SELECT {select_list('round({c}, 6) AS {c}')} FROM ({MEANS})", "dirty"))
def _(t):
    return rounded(clean.impute(t.dirty(), "mean"))


@query("c_median", sql("SELECT " + select_list(
    "coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM dirty)) AS {c}") + " FROM dirty", "dirty"))
def _(t):
    return clean.impute(t.dirty(), "median")


@query("c_constant", sql(f"SELECT {select_list('coalesce({c}, 0.0e0) AS {c}')} FROM dirty",
                         "dirty"))
def _(t):
    return clean.impute(t.dirty(), "constant")


TEXTS = {"p_partkey": "p_partkey",
         "p_brand": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END",
         "p_type": "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END",
         "nothing": "CAST(NULL AS {text})"}


def mode_sql(column: str, table: str) -> str:
    return (f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}"
            f" ORDER BY count(*) DESC, {column} LIMIT 1)")


@query("c_mode_cat", sql(
    "SELECT p_partkey, " + ", ".join(
        f"coalesce({c}, {mode_sql(c, 'texts')}, 'Unknown') AS {c}"
        for c in ("p_brand", "p_type", "nothing")) + " FROM texts",
    extra={"texts": "SELECT " + ", ".join(
        f"{e.format(text='VARCHAR')} AS {c}" for c, e in TEXTS.items()) + " FROM part"}))
def _(t):
    texts = t.read("part").selectExpr(
        *[f"{e.format(text='STRING')} AS {c}" for c, e in TEXTS.items()])
    return clean.impute(texts, "mode", ["p_brand", "p_type", "nothing"])


@query("c_mode_num", sql("SELECT " + ", ".join(
    f"coalesce({c}, {mode_sql(c, 'dirty')}) AS {c}" for c in RAW_COLUMNS) + " FROM dirty",
    "dirty"))
def _(t):
    return clean.impute(t.dirty(), "mode")


@query("c_missing_report", sql(
    "SELECT 'mean' AS strategy, CAST(" + " + ".join(f"(count(*) - count({c}))"
                                                   for c in RAW_COLUMNS)
    + " AS BIGINT) AS missing_before, CAST(0 AS BIGINT) AS missing_after, CAST("
    + " + ".join(f"(count(*) - count({c}))" for c in RAW_COLUMNS)
    + " AS BIGINT) AS missing_removed FROM dirty", "dirty"))
def _(t):
    dirty = t.dirty()
    return clean.missing_report(dirty, clean.impute(dirty, "mean"), "mean")


@query("c_knn")
def _(t):
    return rounded(clean.impute(t.dirty(), "knn"))


PART_GAPS = {"size": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END",
             "price": "CASE WHEN p_partkey % 7 < 2 THEN NULL ELSE p_retailprice END",
             "spot": "CAST(p_partkey % 101 AS DOUBLE)"}


def near_sql(query: str, donor: str, names: list[str], total: int) -> str:
    """Square distance over the columns that both rows have, scaled by all / shared columns."""
    square = " + ".join(f"coalesce(({query}.{c} - {donor}.{c}) * ({query}.{c} - {donor}.{c}), 0)" for c in names)
    shared = " + ".join(f"CAST({query}.{c} IS NOT NULL AND {donor}.{c} IS NOT NULL AS INTEGER)" for c in names)
    return f"({square}) * ({total}.0e0 / nullif({shared}, 0))"


def filled_sql(target: str) -> str:
    """The mean of the five nearest rows that have the value; ties go to the smaller value."""
    near = near_sql("q", "d", list(PART_GAPS), len(PART_GAPS))
    return (f"SELECT p_partkey, avg(value) AS value FROM (SELECT q.p_partkey, d.{target} AS value, row_number() OVER (PARTITION BY"
            f" q.p_partkey ORDER BY {near}, d.{target}) AS place FROM rows AS q JOIN rows AS d ON q.{target} IS NULL AND d.{target}"
            f" IS NOT NULL AND {near} IS NOT NULL) WHERE place <= 5 GROUP BY p_partkey")


@query("c_knn_part", sql(
    "SELECT round(coalesce(size, a.value), 6) AS size, round(coalesce(price, b.value), 6) AS price, spot FROM rows LEFT JOIN"
    f" ({filled_sql('size')}) AS a USING (p_partkey) LEFT JOIN ({filled_sql('price')}) AS b USING (p_partkey)",
    extra={"rows": "SELECT p_partkey, " + ", ".join(f"{e} AS {c}" for c, e in PART_GAPS.items()) + " FROM part"}))
def _(t):
    return rounded(clean.impute(t.read("part").selectExpr(*[f"{e} AS {c}" for c, e in PART_GAPS.items()]), "knn"))


@query("c_dedup_first", sql(f"SELECT DISTINCT {COLUMN_LIST} FROM dirty", "dirty"))
def _(t):
    return clean.dedup(t.dirty())


@query("c_dedup_none", sql(
    f"SELECT {COLUMN_LIST} FROM dirty GROUP BY {COLUMN_LIST} HAVING count(*) = 1", "dirty"))
def _(t):
    return clean.dedup(t.dirty(), keep=False)


@query("c_dup_report", sql(
    "SELECT d AS duplicates_before, d AS duplicates_removed, 'first' AS keep_strategy FROM"
    " (SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM plain)) AS BIGINT) AS"
    " d FROM plain)", "dirty", extra={"plain": f"SELECT {COLUMN_LIST} FROM dirty"}))
def _(t):
    return clean.duplicate_report(t.dirty())


def fence_steps(source: str, columns: list[str]) -> dict[str, str]:
    """One CTE per column: the rows of the step before that lie inside its fences."""
    out, last = {}, source
    for i, c in enumerate(columns):
        fences = (f"SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3"
                  f" FROM {last}")
        out[f"kept{i}"] = (
            f"SELECT {COLUMN_LIST} FROM {last}, ({fences}) WHERE NOT coalesce("
            f"{c} < q1 - 1.5e0 * (q3 - q1) OR {c} > q3 + 1.5e0 * (q3 - q1), false)")
        last = f"kept{i}"
    return out


MEAN_DEDUP = {"based": f"SELECT DISTINCT * FROM ({MEANS})"}
SEQUENCE = {**MEAN_DEDUP, **fence_steps("based", FEATURES)}


def based(t):
    return clean.dedup(clean.impute(t.dirty(), "mean"))


@query("c_iqr_seq", sql(f"SELECT {select_list('round({c}, 6) AS {c}')} FROM kept7", "dirty",
                        extra=SEQUENCE))
def _(t):
    base = stage(based(t), "base")
    return rounded(clean.fit_outliers(base, "iqr", FEATURES).apply(base))


@query("c_iqr_nulls", sql(f"SELECT {COLUMN_LIST} FROM kept8", "dirty",
                          extra=fence_steps("dirty", RAW_COLUMNS)))
def _(t):
    """Missing cells pass every fence."""
    dirty = stage(t.dirty(), "dirty")
    return clean.fit_outliers(dirty, "iqr").apply(dirty)


@query("c_iqr_onepass", sql(
    f"SELECT {select_list('round({c}, 6) AS {c}')} FROM based, (SELECT "
    + ", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}"
                for c in FEATURES) + " FROM based) WHERE "
    + " AND ".join(f"NOT ({c} < a_{c} - 1.5e0 * (b_{c} - a_{c}) OR {c} > b_{c} + 1.5e0 *"
                   f" (b_{c} - a_{c}))" for c in FEATURES), "dirty", extra=MEAN_DEDUP))
def _(t):
    base = stage(based(t), "base")
    return rounded(clean.fit_outliers(base, "iqr", FEATURES, sequential=False).apply(base))


SPIKY = ", ".join("CASE WHEN row_key % 500 = 0 THEN sqft_lot * 20 ELSE sqft_lot END AS sqft_lot"
                  if c == "sqft_lot" else c for c in RAW_COLUMNS)


def zscore_steps(source: str, columns: list[str]) -> dict[str, str]:
    out, last = {}, source
    for i, c in enumerate(columns):
        out[f"z{i}"] = (
            f"SELECT {COLUMN_LIST} FROM {last}, (SELECT avg({c}) AS m, stddev_pop({c}) AS s"
            f" FROM {last}) WHERE coalesce(abs(({c} - m) / NULLIF(s, 0)) <= 3, true)")
        last = f"z{i}"
    return out


@query("c_zscore", sql(f"SELECT {COLUMN_LIST} FROM z8", "listings", extra={
    "spiky": f"SELECT {SPIKY} FROM listings", **zscore_steps("spiky", RAW_COLUMNS)}))
def _(t):
    spiky = stage(t.listings(key=True).selectExpr(*[
        "CASE WHEN row_key % 500 = 0 THEN sqft_lot * 20 ELSE sqft_lot END AS sqft_lot"
        if c == "sqft_lot" else c for c in RAW_COLUMNS]), "spiky")
    return clean.fit_outliers(spiky, "zscore").apply(spiky)


@query("c_outlier_report", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST((SELECT count(*) FROM {a}) - (SELECT count(*) FROM {b})"
    f" AS BIGINT) AS rows_removed, 'iqr' AS method, CAST(1.5 AS DOUBLE) AS factor"
    for c, a, b in zip(FEATURES, ["based", *[f"kept{i}" for i in range(7)]],
                       [f"kept{i}" for i in range(8)])), "dirty", extra=SEQUENCE))
def _(t):
    base = stage(based(t), "base")
    return clean.fit_outliers(base, "iqr", FEATURES).report(base)


def typed(t):
    """A column of numbers as text, one with a few unfit cells, and a plain text column."""
    return t.listings(key=True).selectExpr(
        "row_key", "CAST(CAST(grade AS BIGINT) AS STRING) AS grade_text",
        "CASE WHEN row_key % 50 = 0 THEN 'n/a' ELSE CAST(CAST(age AS BIGINT) AS STRING) END"
        " AS age_text", "CASE WHEN row_key % 9 = 0 THEN NULL ELSE"
        " CAST(CAST(sqft_lot AS BIGINT) AS STRING) END AS lot_text", "price")


TYPED = ("SELECT row_key, CAST(CAST(grade AS BIGINT) AS VARCHAR) AS grade_text, CASE WHEN"
         " row_key % 50 = 0 THEN 'n/a' ELSE CAST(CAST(age AS BIGINT) AS VARCHAR) END AS age_text,"
         " CASE WHEN row_key % 9 = 0 THEN NULL ELSE CAST(CAST(sqft_lot AS BIGINT) AS VARCHAR) END"
         " AS lot_text, price FROM listings")


@query("c_autotype", sql(
    "SELECT row_key, CAST(grade_text AS DOUBLE) AS grade_text, age_text,"
    f" CAST(lot_text AS DOUBLE) AS lot_text, price FROM ({TYPED})", "listings"))
def _(t):
    return clean.auto_numeric(typed(t))


@query("c_casttypes", sql(
    "SELECT row_key, CAST(grade_text AS BIGINT) AS grade_text, age_text, CAST(lot_text AS BIGINT)"
    f" AS lot_text, CAST(price AS BIGINT) AS price FROM ({TYPED})", "listings"))
def _(t):
    return clean.cast_types(typed(t), {"grade_text": "int", "age_text": "int", "lot_text": "int",
                                       "price": "int64", "absent": "float"})


def scaled_sql(centre: str, width: str) -> str:
    """Scale all columns but price; a constant column is part of the table."""
    names = [*FEATURES, "steady"]
    stats = ", ".join(f"{centre} AS m_{c}, {width} AS w_{c}".replace("{c}", c) for c in names)
    cells = ", ".join(f"round(({c} - m_{c}) / CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END, 6) AS {c}"
                      for c in names)
    return sql(f"SELECT {cells}, price FROM even, (SELECT {stats} FROM even)", "listings",
               extra={"even": f"SELECT {COLUMN_LIST}, CAST(5 AS DOUBLE) AS steady FROM listings"})


def even(t):
    return t.listings().withColumn("steady", F.lit(5.0))


@query("c_standard", scaled_sql("avg({c})", "stddev_pop({c})"))
def _(t):
    return rounded(scale.scale(even(t), "standard", ["price"]))


@query("c_minmax", scaled_sql("min({c})", "(max({c}) - min({c}))"))
def _(t):
    return rounded(scale.scale(even(t), "minmax", ["price"]))


@query("c_robust", scaled_sql("quantile_cont({c}, 0.5)",
                              "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"))
def _(t):
    return rounded(scale.scale(even(t), "robust", ["price"]))


@query("c_pipeline", sql(
    "SELECT " + ", ".join(f"round(({c} - m_{c}) / CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END, 6)"
                          f" AS {c}" for c in FEATURES)
    + ", round(price, 6) AS price FROM kept7, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS w_{c}" for c in FEATURES)
    + " FROM kept7)", "dirty", extra=SEQUENCE))
def _(t):
    return rounded(jobs.clean_job(t.dirty(), scaling="standard").table)


@query("c_pipeline_outliers", sql(outliers_sql("kept7"), "dirty", extra=SEQUENCE))
def _(t):
    """Profile of the cleaned table."""
    from tablewright.operators import profile

    return profile.outliers(jobs.clean_job(t.dirty()).table)
