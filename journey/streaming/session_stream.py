"""Streaming session flags with event-time session windows.

A session's events are grouped by its id and a ``session_window`` on the
event timestamp; with a watermark, append mode emits each session's flags
once, after the watermark has passed the end of its window, and drops its
state.  State is therefore bounded by the sessions still open, not by
history.  A session whose events are further apart than ``gap`` is emitted
as several windows; ``funnel_from_flags`` merges them again by session id.

Events that arrive later than the watermark allows are dropped by Spark, as
with any watermark: counts equal the batch funnel only as far as no event is
later than that.  Events without a session id or time are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from journey.operators.flags import flag_sums, funnel_rows
from journey.spec import FunnelSpec


def stream_session_flags(events: DataFrame, spec: FunnelSpec, gap: str = "30 minutes",
                         watermark: str = "1 hour") -> DataFrame:
    """Streaming ``session_id, session_start, session_end, s0..`` (one row per closed session window)."""
    ev = F.col(spec.event_col)
    # watermarks need TIMESTAMP; a TIMESTAMP_NTZ event time is read in the session time zone
    src = events.filter(F.col(spec.session_col).isNotNull() & F.col(spec.ts_col).isNotNull()) \
        .withColumn("_event_time", F.col(spec.ts_col).cast("timestamp")).withWatermark("_event_time", watermark)
    agg = src.groupBy(F.col(spec.session_col), F.session_window(F.col("_event_time"), gap).alias("_w")).agg(
        *[F.max(F.when(ev == F.lit(n), F.lit(1)).otherwise(F.lit(0))).alias(spec.flag(i)) for i, n in enumerate(spec.names)]
    )
    return agg.select(
        spec.session_col,
        F.col("_w.start").alias("session_start"),
        F.col("_w.end").alias("session_end"),
        *spec.flag_cols(),
    )


def flags_sink(flags: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append closed sessions to a Parquet table; progress is kept in ``checkpoint``.

    ``checkpoint`` belongs to this one stream: a shared folder that outlives
    the application, and another one for each sink.
    """
    w = flags.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(path)


def funnel_from_flags(flags: DataFrame, spec: FunnelSpec) -> DataFrame:
    """Q1 over a (batch) flag table: windows of one session are merged first."""
    per_session = flags.groupBy(spec.session_col).agg(*[F.max(c).alias(c) for c in spec.flag_cols()])
    return per_session.agg(*flag_sums(spec)).select(F.inline(funnel_rows(spec)))
