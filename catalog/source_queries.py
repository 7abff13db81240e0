"""Source, sink, registry and run summary queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.fixtures import COLUMN_LIST, sql
from catalog.registry import query, rounded
from tablewright.operators import linear, monitor
from tablewright.plans import jobs
from tablewright.session import stage, staging_root
from tablewright.sources import store, synth
from tablewright.sources.tables import read_table, write_table


def folder(t, name: str) -> str:
    return f"{staging_root(t.spark)}/{name}-{uuid.uuid4().hex}"


@query("s_csv_roundtrip", sql(f"SELECT {COLUMN_LIST} FROM dirty", "dirty"))
def _(t):
    """Write CSV with empty cells, read it back with inferred types."""
    path = write_table(t.dirty(), folder(t, "table") + ".csv")
    return read_table(t.spark, path)


@query("s_csv_schema", sql(f"SELECT {COLUMN_LIST} FROM dirty", "dirty"))
def _(t):
    dirty = t.dirty()
    path = write_table(dirty, folder(t, "table") + ".csv")
    return read_table(t.spark, path, schema=dirty.schema)


@query("s_parquet_roundtrip", sql(f"SELECT {COLUMN_LIST} FROM dirty", "dirty"))
def _(t):
    return read_table(t.spark, write_table(t.dirty(), folder(t, "table")))


NAMES_SQL = ("SELECT 'best_model_' || strftime(o_orderdate, '%Y%m%d') || CASE WHEN o_orderpriority"
             " = '1-URGENT' THEN '_info' ELSE '' END AS name FROM orders")


@query("s_latest_model", f"SELECT max(name) AS latest_model FROM ({NAMES_SQL}) WHERE name NOT LIKE"
                         " '%\\_info%' ESCAPE '\\'")
def _(t):
    suffix = F.when(F.col("o_orderpriority") == "1-URGENT", "_info").otherwise("")
    names = t.read("orders").select(F.concat(
        F.lit("best_model_"), F.date_format("o_orderdate", "yyyyMMdd"), suffix).alias("name"))
    return store.latest_model(names)


@query("s_model_roundtrip", sql(
    "SELECT row_key, round(i + s * sqft_living, 4) AS prediction FROM listings, (SELECT"
    " regr_slope(price, sqft_living) AS s, regr_intercept(price, sqft_living) AS i FROM listings)",
    "listings"))
def _(t):
    """Predictions of a model that was saved and loaded."""
    rows = t.listings(key=True)
    model = linear.fit_linear(rows, ["sqft_living"], "price")
    path = store.save_model(t.spark, model, folder(t, "model"))
    return rounded(store.load_model(t.spark, path).transform(rows)
                   .select("row_key", "prediction"), 4)


@query("s_package_baseline", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std,"
    f" min({c}) AS min, max({c}) AS max FROM listings"
    for c in COLUMN_LIST.split(", ") if c != "price"), "listings"))
def _(t):
    """Baseline statistics read back from a deployment package."""
    rows = t.listings()
    model = linear.fit_linear(rows, ["sqft_living"], "price")
    path = folder(t, "package")
    store.save_package(t.spark, path, model, {"version": "1.0"}, model.features, rows)
    return rounded(store.load_baseline(t.spark, path)
                   .select("column_name", "mean", "std", "min", "max"), 5)


@query("s_history", sql(
    "SELECT model, round(avg(prediction), 4) AS mean, count(*) AS input_rows FROM scored GROUP BY"
    " model", "scored"))
def _(t):
    """Prediction log rows appended one batch at a time."""
    path, rows = folder(t, "history"), t.scored_models()
    for model in ("sqft_living", "grade", "condition"):
        entry = monitor.prediction_log(rows.filter(F.col("model") == model))
        store.append_history(entry.withColumn("model", F.lit(model)), path)
    return rounded(store.read_history(t.spark, path).select("model", "mean", "input_rows"), 4)


@query("s_dup_inject")
def _(t):
    return synth.add_duplicates(t.listings(), 0.08)


@query("s_null_inject")
def _(t):
    return synth.add_gaps(t.listings(), 0.15)


@query("s_dup_counts", sql(
    "SELECT count(*) + CAST(floor(count(*) * 0.08) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS foreign_rows"
    " FROM listings", "listings"))
def _(t):
    """Rows with copies, original rows that are missing, and rows that are no copy of one."""
    base = stage(t.listings(), "base")
    both = stage(synth.add_duplicates(base, 0.08), "both")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.lit(base.exceptAll(both).count()).cast("long").alias("lost"),
                    F.lit(both.join(base.distinct(), base.columns, "left_anti").count()).cast("long").alias("foreign_rows"))


@query("s_null_counts", sql(
    "SELECT count(*) AS rows, " + ", ".join(f"count({c}) AS n_{c}" for c in ("l_suppkey", "l_linenumber"))
    + ", CAST(0 AS BIGINT) AS changed FROM lineitem"))
def _(t):
    """Whole rows stay, and so do the columns that no gaps are made in; no other cell changes."""
    rows = t.read("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount")
    kept = synth.add_gaps(rows, 0.15, columns=["l_quantity", "l_discount"])
    both = rows.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("was"), F.col("l_discount").alias("had")).distinct()
    moved = stage(kept.join(both, ["l_orderkey", "l_linenumber"], "left").groupBy("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount")
                  .agg(F.max((F.coalesce(F.col("l_quantity") == F.col("was"), F.col("l_quantity").isNull())
                              & F.coalesce(F.col("l_discount") == F.col("had"), F.col("l_discount").isNull())).cast("int")).alias("same")), "moved")
    return kept.agg(F.count(F.lit(1)).alias("rows"), F.count("l_suppkey").alias("n_l_suppkey"), F.count("l_linenumber").alias("n_l_linenumber"),
                    F.lit(moved.where("same = 0").count()).cast("long").alias("changed"))


@query("r_summary",
       "SELECT CAST(user_id AS VARCHAR) AS run_id, count(*) FILTER (status = 'success') AS"
       " successful_stages, round(count(*) FILTER (status = 'success') * 100.0e0 / 5, 1) AS"
       " success_rate FROM (SELECT user_id, event_type, CASE WHEN avg(value) >= 0 AND count(*) % 3"
       " > 0 THEN 'success' ELSE 'failed' END AS status FROM events GROUP BY user_id, event_type)"
       " GROUP BY user_id")
def _(t):
    """Events stand for stages: one status per user and event type."""
    good = (F.avg("value") >= 0) & (F.count(F.lit(1)) % 3 > 0)
    status = t.read("events").groupBy(F.col("user_id").cast("string").alias("run_id"),
                                      "event_type") \
        .agg(F.when(good, "success").otherwise("failed").alias("status"))
    return jobs.run_summary(status)
