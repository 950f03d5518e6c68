"""Token counts: batch encoding in Arrow functions that return lengths only.

Each task cuts its texts at safe places (``encoders``), gives the library
batches of about equal bytes and keeps nothing but the numbers of ids.  A very
long text is encoded stretch by stretch, so memory is bounded by the longest
stretch that holds no safe place.  One pass, no shuffle; a lost task counts
again.

Defined cases
    null or empty text: no bytes, no tokens.  Bytes that are not UTF-8: counted
    as they are in ``n_bytes``, encoded as replacement characters.  Repeated rows:
    each counted.  Null ids and further columns: carried.  Empty table: empty
    result.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from journey.llm.common import free_name, give_back, q
from journey.llm.encoders import Encoder

#: tokens beyond which a text is over the limit, by contract
LIMIT = 1024
#: bytes of text that a worker holds as Python strings at once, one text at least
SLICE_BYTES = 2 << 20


def byte_ranges(sizes: list[int], limit: int):
    """Consecutive (first, end) row ranges of at most ``limit`` bytes each, one row at least."""
    first, held = 0, 0
    for i, n in enumerate(sizes):
        if i > first and held + n > limit:
            yield first, i
            first, held = i, 0
        held += n
    if first < len(sizes):
        yield first, len(sizes)


def count_tokens(df: DataFrame, tokenizer_path: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",),
                 limit: int = LIMIT) -> DataFrame:
    """Carried columns, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    The carried columns must not have one of these names.
    """
    clash = {c.lower() for c in carry} & {"n_bytes", "n_tokens", "over_limit"}
    if clash:
        raise ValueError(f"carried columns {sorted(clash)} have names of the result")
    body = free_name(list(carry), "text_")
    picked = df.select(*[q(c) for c in carry], q(text).cast("binary").alias(body))
    kept = picked.drop(body).withColumns({"n_bytes": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long")}).schema
    out = to_arrow_schema(kept)

    def run(batches):
        encoder = Encoder.of(tokenizer_path)
        for batch in batches:
            raw = batch.column(batch.num_columns - 1)
            sizes = [0 if n is None else n for n in pa.compute.binary_length(raw).to_pylist()]
            for first, end in byte_ranges(sizes, SLICE_BYTES):
                texts = [(t or b"").decode("utf-8", "replace") for t in raw.slice(first, end - first).to_pylist()]
                part = batch.slice(first, end - first)
                columns = [part.column(i).cast(out.field(i).type) for i in range(len(carry))]
                columns += [pa.array(sizes[first:end], pa.int64()), pa.array(encoder.count(texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=out)
        give_back()

    return picked.mapInArrow(run, kept).withColumn("over_limit", F.col("n_tokens") > limit)
