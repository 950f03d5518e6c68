"""Quality classifier: histogram gradient-boosted trees over document statistics.

One pass computes a fixed set of statistics of every whole text and stores
them.  Trees are grown on a bounded, hash-ordered sample of labelled rows of
the training fold (``MAX_LEARN``, a documented parameter) from histograms of
quantile bins, flattened into arrays, and walked for whole batches at once.

Defined cases
    null or empty text: the statistics of no words.  No labels, or one class
    only: every score is that rate (0.5 without labels).  Repeated labels: the
    mean decides, 0.5 counts as 1.  Null ids: scored, not held out, not
    learned from.  Empty table: empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from journey.llm.common import map_rows, q, stored
from journey.llm.toxicity import fold

# --- fixed values: the contract's fold and threshold; the method's parameters ---------
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5
MAX_LEARN = 20_000
TREES, DEPTH, BINS, RATE, LEAF, LAMBDA = 60, 4, 64, 0.15, 20, 1.0
#: bytes handed to the deflater at once
PIECE = 1 << 16
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SYMBOLS = b"#*$%&|<>"
# ------------------------------------------------------------------------------------------

STATS = ("n_bytes", "n_words", "mean_word", "long_words", "distinct_words", "top_word", "repeat_pairs", "upper", "digits",
         "punctuation", "symbols", "bars", "bangs", "non_ascii", "lines", "mean_line", "distinct_lines", "short_lines",
         "capital_words", "end_marks", "stops", "compression", "same_next")


def deflated(raw: bytes) -> int:
    """Bytes of the whole of ``raw`` when deflated, fed piece by piece so that no output is held."""
    packer = zlib.compressobj(1)
    view = memoryview(raw)
    return sum(len(packer.compress(view[i:i + PIECE])) for i in range(0, len(raw), PIECE)) + len(packer.flush())


def statistics(text: str | None) -> list[float]:
    """The statistics of one text, in ``STATS`` order; shares are of words, lines or bytes."""
    raw = (text or "").encode()
    words = raw.split()
    n, size = len(words), max(1, len(raw))
    count = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    kept = lambda chars: (len(raw) - len(raw.translate(None, chars))) / size
    per = 1 / max(1, n)
    longest = sum(1 for w in words if len(w) > 15)
    return [
        np.log1p(len(raw)), np.log1p(n), sum(map(len, words)) * per, longest * per, len(count) * per,
        max(count.values(), default=0) * per, sum(c for c in pairs.values() if c > 1) / max(1, n - 1),
        kept(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), kept(b"0123456789"), kept(_PUNCTUATION), kept(_SYMBOLS), kept(b"|"),
        kept(b"!"), kept(bytes(range(128, 256))), len(lines) * per, n / max(1, len(lines)),
        len(set(lines)) / max(1, len(lines)), sum(1 for x in lines if len(x) < 20) / max(1, len(lines)),
        sum(1 for w in words if w[:1].isupper()) * per, raw.count(b".") * per, raw.count(b",") * per,
        deflated(raw) / size,
        sum(1 for a, b in zip(words, words[1:], strict=False) if a == b) * per,
    ]


class Trees:
    """Boosted trees as flat arrays: node i goes left if x[feature] <= threshold; leaves have feature -1."""

    def __init__(self, base: float):
        self.base = base
        self.feature: list[int] = []
        self.threshold: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.value: list[float] = []
        self.roots: list[int] = []

    def node(self) -> int:
        for a, x in ((self.feature, -1), (self.threshold, 0.0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            a.append(x)
        return len(self.feature) - 1

    def arrays(self) -> tuple:
        return (self.base, np.array(self.roots), np.array(self.feature), np.array(self.threshold), np.array(self.left),
                np.array(self.right), np.array(self.value), DEPTH)


def walk(arrays: tuple, x: np.ndarray) -> np.ndarray:
    """Logits of the rows of ``x``: all rows go down all trees together."""
    base, roots, feature, threshold, left, right, value, depth = arrays
    if not len(roots):
        return np.full(len(x), base)
    at = np.broadcast_to(roots, (len(x), len(roots))).copy()
    rows = np.arange(len(x))[:, None]
    for _ in range(depth):
        f = feature[at]
        down = np.where(x[rows, np.maximum(f, 0)] <= threshold[at], left[at], right[at])
        at = np.where(f >= 0, down, at)
    return base + value[at].sum(axis=1)


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees:
    """Boost ``trees`` trees on log loss; splits come from gradient histograms over quantile bins."""
    rate = y.mean() if len(y) else 0.5
    model = Trees(float(np.log((rate + 1e-6) / (1 - rate + 1e-6))))
    if not len(y) or rate in (0.0, 1.0):
        return model
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    flat = binned + np.arange(x.shape[1]) * bins  # one histogram for all features
    z = np.full(len(y), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, p * (1 - p)

        def split(rows, level):
            node = model.node()
            sum_g, sum_h = g[rows].sum(), h[rows].sum()
            best = None
            if level < depth and len(rows) >= 2 * LEAF:
                size = x.shape[1] * bins
                each = flat[rows].ravel()
                hists = [np.bincount(each, np.repeat(a[rows], x.shape[1]), size).reshape(-1, bins).cumsum(axis=1)
                         for a in (g, h)]
                n_left = np.bincount(each, minlength=size).reshape(-1, bins).cumsum(axis=1)
                gl, hl = hists
                gain = gl ** 2 / (hl + LAMBDA) + (sum_g - gl) ** 2 / (sum_h - hl + LAMBDA) - sum_g ** 2 / (sum_h + LAMBDA)
                gain[(n_left < LEAF) | (len(rows) - n_left < LEAF)] = -1
                j, b = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[j, b] > 1e-6 and b < len(cuts[j]):
                    best = (j, b)
            if best is None:
                model.value[node] = -RATE * sum_g / (sum_h + LAMBDA)
                z[rows] += model.value[node]
                return node
            j, b = best
            goes = binned[rows, j] <= b
            model.feature[node], model.threshold[node] = int(j), float(cuts[j][b])
            model.left[node] = split(rows[goes], level + 1)
            model.right[node] = split(rows[~goes], level + 1)
            return node

        model.roots.append(split(np.arange(len(y)), 0))
    return model


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          threshold: float = THRESHOLD, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    kind = docs.select(q(doc_id)).schema[0].dataType.simpleString()
    picked = docs.select(q(doc_id).alias("doc_id"), q(text).cast("string").alias("text_"))
    stats = stored(map_rows(picked, lambda c: {"doc_id": c["doc_id"], "x": [statistics(t) for t in c["text_"]]},
                            f"doc_id {kind}, x array<double>"), "quality-stats")
    learn = labels.select(q(doc_id).alias("doc_id"), q(label).alias("y")).where(F.col("y").isNotNull())
    learn = learn.where(fold(F.col("doc_id"), folds) != held_out).groupBy("doc_id").agg(
        (F.avg("y") >= 0.5).cast("double").alias("y"))
    learn = learn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LEARN)
    # one row for an id however many rows repeat it: at most MAX_LEARN rows
    got = stats.join(F.broadcast(learn), "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.first("y").alias("y")).toPandas()
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, len(STATS)))
    order = np.lexsort(x.T) if len(x) else np.zeros(0, int)  # the same trees whatever order the rows came in
    arrays = grow(x[order], got["y"].to_numpy(float)[order]).arrays()
    ddl = f"doc_id {kind}, held_out boolean, score double, predicted int"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        for batch in batches:
            values = np.asarray(batch.column("x").flatten()).reshape(-1, len(STATS))
            for at in range(0, len(values), 4096):
                z = walk(arrays, values[at:at + 4096])
                s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                part = batch.slice(at, 4096)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(schema.field(0).type), part.column("held_out"), pa.array(s),
                     pa.array((s >= threshold).astype(np.int32))], schema=schema)

    held = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out")
    return stats.select("doc_id", held, "x").mapInArrow(run, ddl)
