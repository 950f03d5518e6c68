"""S6 + A3: incremental funnel state — session flags kept by day, a rerun reads new days only.

``FunnelState`` keeps one flag row per (day, session) under a folder that all
executors share, and a ledger of the days that are in it:

    <path>/flags/batch=<id>/day=<date>/…    flags written by one update
    <path>/ledger/…                         (seq, batch, day, sessions) per committed day

An update writes its flags to a folder of its own first and appends its ledger
rows last, in one file.  What an update that died left behind has no ledger
row and is never read.  A day that is processed again gets a newer ledger row,
which replaces the older one's flags.  Flags merge by ``max``, so a session that
goes on over midnight counts once.  One writer at a time.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from journey.functions.sqltext import ident
from journey.operators.flags import FLAG, session_facts
from journey.spec import FunnelSpec

LEDGER = "seq long, batch string, day date, sessions long"


class FunnelState:
    """Flags of ``names`` (the funnel's stages by default) per session, kept by day below ``path``."""

    def __init__(self, spark: SparkSession, path: str, spec: FunnelSpec, names=None):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.names = list(dict.fromkeys(names or spec.names))

    def ledger(self) -> DataFrame:
        """The days in force: (day, seq, batch, sessions), the latest row of each day."""
        try:
            rows = self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], LEDGER)
        latest = rows.groupBy("day").agg(F.max_by(F.struct("seq", "batch", "sessions"), "seq").alias("l"))
        return latest.select("day", "l.*")

    def update(self, events: DataFrame, day_col: str, again: list[dt.date] = ()) -> list[dt.date]:
        """Take in the days of ``events`` that the ledger lacks, and those of ``again`` anew; returns them.

        ``day_col`` is a DATE column, best the one by which the log is stored
        partitioned: then no file of another day is opened.  Rows without a day or a
        session id are left out.
        """
        known = self.ledger()
        have = {r["day"] for r in known.select("day").collect()}  # one row per day of history
        wanted = sorted(set(again))
        old = sorted(have - set(again))
        candidates = events.filter(~F.col(day_col).isin(old) | F.col(day_col).isin(wanted)) if old else events
        days = sorted({r[0] for r in candidates.select(day_col).distinct().collect()} - {None})
        if not days:
            return []
        batch = uuid.uuid4().hex
        out = f"{self.path}/flags/batch={batch}"
        new = events.filter(F.col(day_col).isin(days)).withColumn("day", F.col(day_col))
        flags = session_facts_by_day(new, self.spec, self.names)
        flags.write.partitionBy("day").parquet(out)
        seq = 1 + (known.agg(F.max("seq")).first()[0] or 0)
        written = self.spark.read.schema(self._schema()).parquet(out).groupBy("day").agg(F.count(F.lit(1)).alias("sessions"))
        taken = self.spark.createDataFrame([(d,) for d in days], "day date")  # a day of rows without a session counts as read
        rows = taken.join(written, "day", "left").select(
            F.lit(seq).cast("long").alias("seq"), F.lit(batch).alias("batch"), "day",
            F.coalesce("sessions", F.lit(0)).cast("long").alias("sessions"))
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")
        return days

    def _schema(self) -> str:
        return ", ".join([f"{ident(self.spec.session_col)} string", *[f"{ident(FLAG + n)} int" for n in self.names], "day date"])

    def flags(self) -> DataFrame:
        """One row per session: a ``flag_table`` over all days in force."""
        try:
            kept = self.spark.read.schema(self._schema() + ", batch string").parquet(f"{self.path}/flags")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            kept = self.spark.createDataFrame([], self._schema() + ", batch string")
        current = kept.join(self.ledger().select("batch", "day"), ["batch", "day"], "left_semi")
        return current.groupBy(self.spec.session_col).agg(*[F.max(F.col(ident(FLAG + n))).alias(FLAG + n) for n in self.names])


def session_facts_by_day(events: DataFrame, spec: FunnelSpec, names) -> DataFrame:
    """Flags per (session, ``day``): ``session_facts`` of a key that holds the day, so partial sums stay on the map side."""
    key = "_session_day"
    keyed = events.filter(F.col(spec.session_col).isNotNull()).withColumn(
        key, F.struct(F.col(spec.session_col).cast("string").alias("s"), F.col("day").alias("d")))
    by_day = FunnelSpec(spec.stages, key, spec.event_col, spec.ts_col, spec.order_col, spec.props_col)
    facts = session_facts(keyed, by_day, names)
    return facts.select(F.col(f"{key}.s").alias(spec.session_col), *[F.col(ident(FLAG + n)) for n in names],
                        F.col(f"{key}.d").alias("day"))
