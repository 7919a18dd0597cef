"""M7: windowed error monitoring, batch or streaming; M1: drift of a stream against a stored
reference.

The same function works on a static frame and on a streaming frame; for a
stream, pass ``watermark`` so that each tumbling window is emitted once in
append mode and rows arriving later than the watermark are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAPE_ALERT = 60.0  # percent (the reference's stated retrain rule)


def windowed_error(df: DataFrame, ts: str, y: str, p: str, window: str = "3 days", watermark: str | None = None,
                   alert_mape: float = MAPE_ALERT) -> DataFrame:
    """Per tumbling window: n, MAE, MAPE (÷ max(y,1)) and an alert when MAPE
    exceeds ``alert_mape``."""
    src = df.withWatermark(ts, watermark) if watermark else df
    ae = F.abs(F.col(y) - F.col(p))
    g = src.groupBy(F.window(F.col(ts), window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(ae).alias("mae"),
        (F.avg(ae / F.greatest(F.col(y), F.lit(1.0))) * 100).alias("mape"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "mae", "mape",
                    (F.col("mape") > F.lit(alert_mape)).alias("alert"))


def drift_stream(stream: DataFrame, state: str, sink_path: str, checkpoint: str, available_now: bool = True):
    """Start a stream that compares every micro-batch with a written drift state
    (``drift.save_reference``) and writes one report per batch (folder ``batch=<id>``): the
    reference's rows are never read again. A batch that is repeated after a failure replaces
    its own report."""
    from faresight.operators.drift import drift_against

    def report(batch: DataFrame, batch_id: int) -> None:
        drift_against(batch.sparkSession, state, batch).write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")
    w = stream.writeStream.foreachBatch(report).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
