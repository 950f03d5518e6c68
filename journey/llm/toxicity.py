"""Toxicity by non-negative positive-unlabelled learning.

Positives are rows confirmed toxic in the training fold; the unlabelled set is
a hash-ordered sample of the training fold's documents whatever their label.
Numpy classifiers (one for each seed) minimise the class-prior-corrected risk
``prior * R+(P) + max(0, R-(U) - prior * R-(P))``; where the bracket is negative, the
step goes against it.  Their mean logit is the score.

Bounds (documented parameters): at most ``MAX_POSITIVE`` and ``MAX_UNLABELLED``
documents are learned from, ``MAX_FEATURES`` features are kept; sampled ids and
features are the only things gathered or broadcast.  Scoring reads every row.

Features are the presence of a text's words and of word beginnings, hashed to
32 bits.  Labels, language, source and id are never features.

Defined cases
    null or empty text: no features, the bias alone scores it.  No positives or
    no documents in the training fold: every score is the prior (0 if there are
    no labels either).  Repeated labels: toxic if any row says so.  Null ids
    are never learned from and not held out.  Empty table: empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from journey.llm.common import map_rows, q
from journey.llm.decontam import words_of

# --- fixed values: the contract's fold and threshold; the method's parameters -----
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
MAX_POSITIVE, MAX_UNLABELLED = 3000, 9000
MAX_FEATURES = 4096
PREFIXES = (4, 5)
#: a feature needs this z value and so many positives
MIN_Z, MIN_ROWS = 4.0, 4
SEEDS, STEPS, RATE, DECAY = 3, 250, 0.05, 2e-3
# ------------------------------------------------------------------------------------


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def parts_of(text: str | None) -> set[bytes]:
    """The text's distinct words, and the beginnings of longer words marked by a star."""
    words = set(words_of(text.lower() if text else text))
    parts = set(words)
    for n in PREFIXES:
        parts.update([w[:n] + b"*" for w in words if len(w) > n])
    return parts


def features_of(text: str | None) -> np.ndarray:
    """Sorted 32-bit hashes of ``parts_of``, as they travel to the trainer."""
    parts = parts_of(text)
    return np.unique(np.fromiter(map(zlib.crc32, parts), np.uint32, len(parts)))


class NonNegativePU:
    """Logistic classifier on binary features, trained by full-batch Adam on the nnPU risk."""

    def __init__(self, prior: float, seed: int, steps: int = STEPS, rate: float = RATE, decay: float = DECAY):
        self.prior, self.seed, self.steps, self.rate, self.decay = prior, seed, steps, rate, decay

    def fit(self, rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int, positive: np.ndarray) -> np.ndarray:
        """Weights of ``n_cols`` features and a bias, from the index pairs of the features present."""
        w = np.random.default_rng(self.seed).normal(0, 0.01, n_cols + 1)
        w[-1] = np.log(self.prior / (1 - self.prior)) if 0 < self.prior < 1 else 0.0
        m, v = np.zeros_like(w), np.zeros_like(w)
        n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())
        for step in range(1, self.steps + 1):
            z = np.bincount(rows, w[cols], n_rows) + w[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            # logistic loss: d loss+ / dz = p - 1, d loss- / dz = p
            loss_minus = np.logaddexp(0, z)
            rest = loss_minus[~positive].sum() / n_u - self.prior * loss_minus[positive].sum() / n_p
            g = np.where(positive, -self.prior * p / n_p, p / n_u)  # of the corrected negative risk
            g = np.where(positive, self.prior * (p - 1) / n_p, 0.0) + g if rest >= 0 else -g
            grad = np.append(np.bincount(cols, g[rows], n_cols), g.sum()) + self.decay * w
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            w = w - self.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        return w


def choose_features(sets: list[np.ndarray], positive: np.ndarray, most: int = MAX_FEATURES) -> np.ndarray:
    """The features whose rate in positives most exceeds that in the unlabelled (two-sample z), sorted."""
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    keys, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    where = np.repeat(positive, [len(s) for s in sets])
    in_p, in_u = (np.bincount(inverse[m], minlength=len(keys)) for m in (where, ~where))
    rate = (in_p + in_u) / (n_p + n_u)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(rate * (1 - rate) * (1 / n_p + 1 / n_u) + 1e-12)
    z[in_p < MIN_ROWS] = 0
    best = np.argsort(-z, kind="stable")[:most]
    return np.sort(keys[best[z[best] > MIN_Z]])


def train(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, folds: int = FOLDS,
          held_out: int = HELD_OUT) -> tuple[dict[bytes, float], float]:
    """(weight of each kept part, bias), learned from bounded samples."""
    learn = labels.select(q(doc_id).alias("id"), q(label).alias("y")).where(F.col("y").isNotNull())
    learn = learn.where(fold(F.col("id"), folds) != held_out).groupBy("id").agg(F.max("y").alias("y"))
    prior = learn.agg(F.avg((F.col("y") == 1).cast("double"))).first()[0] or 0.0
    order = [F.xxhash64("id"), "id"]
    sure = learn.where("y = 1").select("id", F.lit(True).alias("p")).orderBy(*order).limit(MAX_POSITIVE)
    rest = docs.select(q(doc_id).alias("id")).where(fold(F.col("id"), folds) != held_out)
    rest = rest.select("id", F.lit(False).alias("p")).distinct().orderBy(*order).limit(MAX_UNLABELLED)
    picked = F.broadcast(sure.unionByName(rest))  # at most MAX_POSITIVE + MAX_UNLABELLED ids
    sample = docs.select(q(doc_id).alias("id"), q(text).cast("string").alias("text_")).join(picked, "id")
    sample = sample.select(F.col("id").cast("string").alias("id"), "p", "text_")

    def rows(cols):
        return {"id": cols["id"], "p": cols["p"], "f": [features_of(t).tobytes() for t in cols["text_"]]}

    # one row for an id however many rows repeat it, so the bound on ids is a bound on rows; the order is fixed too
    got = map_rows(sample, rows, "id string, p boolean, f binary").groupBy("id", "p").agg(F.min("f").alias("f")).toPandas()
    got = got.sort_values(["id", "p"], ignore_index=True)
    positive = got["p"].to_numpy(bool) if len(got) else np.zeros(0, bool)
    if not positive.any() or positive.all():
        return {}, float(np.log((prior + 1e-9) / (1 - prior + 1e-9)))
    sets = [np.frombuffer(f, np.uint32) for f in got["f"]]
    keys = choose_features(sets, positive)
    present = [np.flatnonzero(np.isin(keys, s, assume_unique=True)) for s in sets]
    r = np.repeat(np.arange(len(sets)), [len(x) for x in present])
    c = np.concatenate(present)
    fits = [NonNegativePU(prior, seed).fit(r, c, len(sets), len(keys), positive) for seed in range(SEEDS)]
    weights = np.mean(fits, axis=0)
    weight = dict(zip(keys.tolist(), weights[:-1].tolist(), strict=True))

    def names(cols):
        found = {p for t in cols["text_"] for p in parts_of(t) if zlib.crc32(p) in weight}
        return {"part": sorted(found)}

    kept = map_rows(sample, names, "part binary").distinct().collect()  # a few times MAX_FEATURES at most
    return {bytes(r["part"]): weight[zlib.crc32(r["part"])] for r in kept}, float(weights[-1])


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          threshold: float = THRESHOLD, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    weights, bias = train(docs, labels, doc_id, text, label, folds, held_out)
    table = docs.sparkSession.sparkContext.broadcast(weights)
    kind = docs.select(q(doc_id)).schema[0].dataType.simpleString()

    def rows(cols):
        known = table.value
        out = []
        for t in cols["text_"]:
            z = bias + sum(known[p] for p in sorted(known.keys() & parts_of(t)))
            out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "score": out,
                "predicted": [int(s >= threshold) for s in out]}

    picked = docs.select(q(doc_id).alias("doc_id"), q(text).cast("string").alias("text_"),
                         F.coalesce(fold(q(doc_id), folds) == held_out, F.lit(False)).alias("held_out"))
    return map_rows(picked, rows, f"doc_id {kind}, held_out boolean, score double, predicted int")
