"""Batch and stream scoring with a fitted model.

The same transformation serves a table and a ``readStream`` source: the
fitted state (frequency maps, category codes) joins the stream as static
tables, the learner scores each micro-batch, and served prices are floored
at 0 and rounded (F19). Invalid requests (P11) are kept with their reason
instead of being scored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from faresight.functions.scalar import serve_prediction
from faresight.operators.validate import validate_requests

REQUIRED = ("airline", "source", "destination", "departure", "stopovers", "aircraft_type", "travel_class",
            "booking_source", "seasonality")
NON_NEGATIVE = ("duration_hrs", "days_before")


def score(model, requests: DataFrame, keep: Sequence[str] = (), domains: dict | None = None) -> DataFrame:
    """Validate, then score the valid rows; invalid rows carry a null price."""
    v = validate_requests(requests, [c for c in REQUIRED if c in requests.columns],
                          [c for c in NON_NEGATIVE if c in requests.columns], domains)
    ok = model.transform(v.where(F.col("valid")))
    served = ok.select(*keep, F.lit("valid").alias("reason"), serve_prediction("prediction").alias("predicted_fare"))
    rejected = v.where(~F.col("valid")).select(*keep, "reason", F.lit(None).cast("double").alias("predicted_fare"))
    return served.unionByName(rejected)


def score_stream(model, source: DataFrame, sink_path: str, checkpoint: str, keep: Sequence[str] = (),
                 available_now: bool = True, domains: dict | None = None):
    """Start a stream that scores ``source`` (a ``readStream`` frame) into a
    parquet sink, with the same checks as the batch form (``domains`` are static tables that
    the stream joins); the checkpoint folder makes it restartable exactly-once."""
    scored = score(model, source, keep, domains)
    w = scored.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.outputMode("append").start()
