"""Streaming session flags give the batch funnel once all sessions are closed."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from journey import operators as op
from journey.streaming import flags_sink, funnel_from_flags, stream_session_flags
from tests.conftest import EVENTS, EVENTS_DDL, STAGES, rows


def test_stream_flags_match_batch(spark, fx):
    d = tempfile.mkdtemp(prefix="journey-stream-", dir=os.environ.get("TMPDIR", "/tmp"))
    src, out, ck = (os.path.join(d, x) for x in ("src", "out", "ck"))
    # the fixture events plus one later event that moves the watermark past every session
    late = [(99, "zz", dt.datetime(2023, 12, 31), "noise", "{}")]
    spark.createDataFrame(EVENTS + late, EVENTS_DDL).write.parquet(src)
    stream = spark.readStream.schema(EVENTS_DDL).parquet(src)
    q = flags_sink(stream_session_flags(stream, STAGES, gap="30 minutes", watermark="1 minute"), out, ck)
    q.awaitTermination(120)
    flags = spark.read.parquet(out)
    batch = op.overall_funnel(fx.events, STAGES)
    cols = ("stage_idx", "session_count")
    assert rows(funnel_from_flags(flags, STAGES), *cols) == rows(batch, *cols)
