"""Journey tables stored bucketed and sorted by session id, for joins and aggregates without a shuffle.

One shuffle when the tables are written replaces one in every query: rows of
a session lie in the same bucket of each table, so aggregates per session and
joins between the tables read bucket against bucket.  The number of buckets
bounds the parallelism of such a query; choose it like
``spark.sql.shuffle.partitions``, so that a bucket fits a task.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journey.operators.flags import flag_table
from journey.sources.io import Tables
from journey.spec import FunnelSpec


@dataclass
class BucketedTables(Tables):
    """``sessions``, ``events``, ``orders`` and ``flags`` as scans of bucketed tables; ``names`` are their catalog entries."""

    flags: DataFrame | None = None
    names: dict[str, str] = field(default_factory=dict)

    def drop(self) -> None:
        """Take the entries out of the session's catalog; the files stay."""
        for name in self.names.values():
            self.sessions.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def store_bucketed(t: Tables, spec: FunnelSpec, path: str, buckets: int | None = None, flag_names=None,
                   event_cols: list[str] | None = None) -> BucketedTables:
    """Write ``t`` below ``path`` (new, shared by all executors), bucketed by the session column, and return its scans.

    ``flags`` holds presence per session of ``flag_names`` (the funnel's stages by
    default).  ``event_cols`` are the columns of the event log worth keeping (all by
    default).  Sessions without an id keep their rows.  Each bucket is one
    sorted file.
    """
    spark = t.sessions.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key, names, scans = spec.session_col, {}, {}
    events = t.events if event_cols is None else t.events.select(*event_cols)
    flags = flag_table(t.events, spec, flag_names or spec.names).filter(F.col(key).isNotNull())
    for kind, df in (("sessions", t.sessions), ("events", events), ("orders", t.orders), ("flags", flags)):
        names[kind] = f"journey_{kind}_{uuid.uuid4().hex}"
        (df.repartition(n, key).write.format("parquet").bucketBy(n, key).sortBy(key)
         .option("path", f"{path.rstrip('/')}/{kind}").saveAsTable(names[kind]))
        scans[kind] = spark.table(names[kind])
    return BucketedTables(scans["sessions"], scans["events"], scans["orders"], flags=scans["flags"], names=names)
