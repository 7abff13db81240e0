"""Scoring, drift and degradation on streams of incoming rows and of late actual values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablewright.fixed_values import LOG_ENTRIES_KEPT
from tablewright.operators import monitor, serve
from tablewright.sources import store
from tablewright.sources.history import PARTS

#: batches that drift is judged over
WINDOW = 10


def _started(rows: DataFrame, handle, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def score_stream(rows: DataFrame, model, features: list[str], base: DataFrame, output: str,
                 checkpoint: str, keep: list[str] | None = None, level: float = 0.05,
                 available_now: bool = True, window: int = WINDOW) -> StreamingQuery:
    """Score every micro-batch, log its prediction statistics and its drift against the baseline.

    Scored and rejected rows of a batch go to its own ``batch_id`` folder. The small tables are
    histories: prediction_log, drift (of the batch), moments, window_drift (of the last ``window``
    batches, from their moments) and alerts. A batch that is replayed after a failure replaces its
    first attempt everywhere, so a restart leaves what one run leaves. The prediction log keeps its
    last rows, and the other histories as many for each feature.
    """
    spark = rows.sparkSession
    # one row for each column, read once
    base = spark.createDataFrame(base.collect(), base.schema)
    kept = {"prediction_log": LOG_ENTRIES_KEPT, "alerts": LOG_ENTRIES_KEPT,
            **{name: LOG_ENTRIES_KEPT * len(features) for name in ("drift", "moments", "window_drift")}}

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            checked = serve.check_rows(batch)
            scored = serve.score(serve.good_rows(checked), model, features, keep=keep)
            target = f"batch_id={batch_id}"
            scored.write.mode("overwrite").parquet(f"{output}/predictions/{target}")
            serve.bad_rows(checked).write.mode("overwrite").parquet(f"{output}/rejected/{target}")
            own = batch.select(*features)
            number = {"batch": F.lit(batch_id), "ts": F.current_timestamp()}

            def log(name: str, table: DataFrame) -> None:
                store.append_history(table, f"{output}/{name}", batch_id)

            log("prediction_log", monitor.prediction_log(scored).withColumn("batch", F.lit(batch_id)))
            found = monitor.drift(base, own, level)
            log("drift", found.withColumns(number))
            log("alerts", monitor.drift_alert(found, F.current_timestamp()).withColumn("batch", F.lit(batch_id)))
            log("moments", monitor.moments(own, base).withColumns(number))
            recent = store.read_history(spark, f"{output}/moments").where(F.col("batch").between(batch_id - window + 1, batch_id))
            log("window_drift", monitor.verdicts(monitor.merged(recent, base), base, level).withColumns(number))
            for name, rows_kept in kept.items():
                store.trim_history(spark, f"{output}/{name}", rows=rows_kept, after=PARTS)
        finally:
            batch.unpersist()

    return _started(rows, handle, checkpoint, available_now)


def actuals_stream(predictions: DataFrame, actuals: DataFrame, key: str, output: str, checkpoint: str,
                   ts: str = "ts", actual_ts: str = "actual_ts", label: str = "label",
                   prediction: str = "prediction", delay: str = "7 days", limit: float = 0.1,
                   model_name: str = "Current Model", available_now: bool = True) -> StreamingQuery:
    """Metrics of every micro-batch of predictions whose actual values have come in.

    Both streams are joined on ``key``; an actual value counts up to ``delay`` after its
    prediction. The watermarks let Spark forget what can no longer meet, so state is bounded by
    the rows of that time. Histories: performance (a row a batch) and degradation (its change from
    the batch before, with a ``declining`` flag); a decline is an alert. Batches without a pair
    leave no row.
    """
    spark = predictions.sparkSession
    left = predictions.withWatermark(ts, delay)
    right = actuals.select(F.col(key).alias("_key"), F.col(actual_ts).alias("_actual_ts"), F.col(label)).withWatermark("_actual_ts", delay)
    pairs = left.join(right, (F.col(key) == F.col("_key")) & (F.col("_actual_ts") >= F.col(ts))
                      & (F.col("_actual_ts") <= F.col(ts) + F.expr(f"INTERVAL {delay}"))).drop("_key")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            number = F.lit(batch_id)
            row = monitor.performance(batch, model_name, label, prediction).withColumn("batch", number)
            store.append_history(row, f"{output}/performance", batch_id)
            history = store.read_history(spark, f"{output}/performance")
            change = monitor.rmse_changes(history.where(F.col("batch") <= number), "batch", limit=limit).where(F.col("batch") == number)
            store.append_history(change, f"{output}/degradation", batch_id)
            alert = change.where("declining").select("ts", F.lit("degradation").alias("alert_type"), F.lit("").alias("affected_features"),
                                                     F.lit(0).cast("long").alias("affected_count"), "batch")
            store.append_history(alert, f"{output}/performance_alerts", batch_id)
            for name in ("performance", "degradation", "performance_alerts"):
                store.trim_history(spark, f"{output}/{name}", after=PARTS)
        finally:
            batch.unpersist()

    return _started(pairs, handle, checkpoint, available_now)
