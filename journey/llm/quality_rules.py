"""Host-level quality rules in DataFrame functions only.

Each text gets rule counts inside its own row (no explode, no shuffle of
text).  Rule failures are aggregated by host (partial aggregation on the map
side, so a host with a third of all rows costs nothing extra), every host's
failure rate is shrunk with a beta prior fitted over all hosts, and the
verdicts are joined back to the documents.

The prior's strength comes from the spread of the hosts' rates without the
part that chance gives hosts of few rows (beta-binomial moments): hosts that
differ by chance only are all taken for the mean host.  A host is rejected
when a document of it fails more likely than not, and surely so: when the
lower limit of its posterior rate (mean less ``HOST_SIGMAS`` standard
deviations) is above ``HOST_LIMIT``.  A host of a few bad documents, or one
that is merely worse than others, keeps its clean documents.

Defined cases
    null or empty text: no words, ``base_failed`` true.  Null host: one host
    of its own, joined null-safe.  Repeated rows: each is judged and counted
    as a row.  Empty table: empty result.  Hosts whose spread says nothing
    (one host, or one row each): the prior falls back to ``MIN_PRIOR``
    pseudo-rows; no more spread than by chance: ``MAX_PRIOR``.
    Columns of the input that clash with working names are left as they are:
    working columns get free names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from journey.llm.common import broadcast_checked, free_name, q, stored

# --- fixed values: the contract's rules and the host verdict's parameters -----
SPACE = "[\\x20\\x09-\\x0D]+"
BLANKS = " \u0009\u000a\u000b\u000c\u000d"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: a host is rejected when the lower limit of its rate of rule failures is above this
HOST_LIMIT = 0.5
#: standard deviations below the posterior mean: one host in a hundred by chance
HOST_SIGMAS = 2.326
#: bounds of the prior, in pseudo-rows
MIN_PRIOR, MAX_PRIOR = 2.0, 10_000.0
# ------------------------------------------------------------------------------

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def rule_counts(df: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """Add the rule counts of column ``text``; ``names`` maps metric to output column.

    Repeated windows: the windows of three words are sorted with their
    positions; a window equal to a neighbour occurs twice or more.  Each
    such position covers three words; a word counts once, so a flagged
    position adds the distance to the next flagged one, three at most.
    """
    cols = list(df.columns)
    t, words, wins, hits = (free_name(cols + list(names.values()), s) for s in ("t_", "w_", "g_", "h_"))
    d = df.withColumn(t, F.coalesce(q(text).cast("string"), F.lit("")))
    d = d.withColumn(words, F.filter(F.split(q(t), SPACE), lambda x: x != ""))
    n = F.size(q(words))
    window = lambda i: F.concat_ws(" ", F.get(q(words), i), F.get(q(words), i + 1), F.get(q(words), i + 2))
    d = d.withColumn(wins, F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)))
    # only texts with some repeated window need the sort
    pairs = F.sort_array(F.transform(q(wins), lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
    d = d.withColumn(hits, F.when(F.size(F.array_distinct(q(wins))) < F.size(q(wins)), pairs))
    near = lambda x, i: (
        F.get(q(hits), i - 1)["g"].eqNullSafe(x["g"]) | F.get(q(hits), i + 1)["g"].eqNullSafe(x["g"]))
    d = d.withColumn(hits, F.sort_array(F.transform(F.filter(q(hits), near), lambda x: x["i"])))
    covered = F.aggregate(
        F.transform(q(hits), lambda x, i: F.least(F.lit(3), F.coalesce(F.get(q(hits), i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    lines = F.filter(F.split(q(t), "\n"), lambda x: _without(x, BLANKS) != "")
    line_col = free_name(cols + list(names.values()) + [t, words, wins, hits], "l_")
    d = d.withColumn(line_col, lines)
    d = d.withColumns({
        names["n_words"]: n.cast("long"),
        names["word_chars"]: F.length(_without(q(t), BLANKS)).cast("long"),
        names["n_symbols"]: (F.length(q(t)) - F.length(_without(q(t), SYMBOLS))).cast("long"),
        names["n_dup_lines"]: (F.size(q(line_col)) - F.size(F.array_distinct(q(line_col)))).cast("long"),
        names["n_repeat_words"]: F.coalesce(covered, F.lit(0)).cast("long"),
    })
    failed = (q(names["n_words"]) < MIN_WORDS) | (
        100 * q(names["n_repeat_words"]) > MAX_REPEAT_PERCENT * q(names["n_words"]))
    return d.withColumn(names["base_failed"], failed).drop(t, words, wins, hits, line_col)


def prior_strength(mean: float | None, var: float | None, chance: float | None) -> float:
    """Pseudo-rows of a beta prior from the mean and variance of the hosts' rates; ``chance`` is the mean of 1 / rows.

    With the prior's strength s, a host's rate has the variance
    mean (1 - mean) (1 / rows + (1 - 1 / rows) / (s + 1)).
    """
    if mean is None or var is None or chance is None or chance >= 1:
        return MIN_PRIOR
    if not 0 < mean < 1:
        return MAX_PRIOR
    spread = (var / (mean * (1 - mean)) - chance) / (1 - chance)
    return min(MAX_PRIOR, max(MIN_PRIOR, 1 / spread - 1)) if spread > 0 else MAX_PRIOR


def host_rates(judged: DataFrame, host: str, failed: str) -> DataFrame:
    """Per host: rows, failures, the failure rate shrunk with an empirical beta prior, and its lower limit.

    The prior's mean is the mean of the hosts' rates, its strength comes
    from their moments, as one aggregate over the hosts.
    """
    hosts = judged.groupBy(q(host).alias("host")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(q(failed).cast("long")).alias("fails"))
    rate = F.col("fails") / F.col("rows")
    mean, var, chance = hosts.agg(F.avg(rate), F.var_samp(rate), F.avg(1 / F.col("rows"))).first()  # three numbers
    strength = prior_strength(mean, var, chance)
    shrunk = (F.col("fails") + (mean or 0.0) * strength) / (F.col("rows") + strength)
    sd = F.sqrt(shrunk * (1 - shrunk) / (F.col("rows") + strength + 1))
    return hosts.select("host", "rows", "fails", shrunk.alias("host_rate"), (shrunk - HOST_SIGMAS * sd).alias("host_low"))


def apply_host_rules(df: DataFrame, text: str = "text", host: str = "source", carry: list[str] | None = None,
                     host_limit: float = HOST_LIMIT) -> tuple[DataFrame, dict[str, str]]:
    """``carry`` columns of ``df`` with rule counts, host rate and verdict; and the names of the added columns.

    The rule counts are written once to the shared folder, since both the
    host aggregate and the verdicts read them.  The hosts are broadcast behind
    a check of their size, so texts do not move; beyond it the join back is on
    the host with the documents' side split by AQE where a host is hot.
    """
    carry = list(df.columns) if carry is None else carry
    names: dict[str, str] = {}
    for m in (*METRICS, "host", "host_rate", "host_low", "kept"):
        names[m] = free_name(carry + list(names.values()) + list(df.columns), m)
    counted = rule_counts(df.withColumn(names["host"], q(host)), text, {m: names[m] for m in METRICS})
    counted = stored(counted.select(*[q(c) for c in (*carry, names["host"], *(names[m] for m in METRICS))]), "rules")
    other = free_name(counted.columns + [names["host_rate"], names["host_low"]], "host_")
    rates = host_rates(counted, names["host"], names["base_failed"]).select(
        F.col("host").alias(other), *[F.col(c).alias(names[c]) for c in ("host_rate", "host_low")])
    rates = broadcast_checked(stored(rates, "host-rates"))
    judged = counted.join(rates, q(names["host"]).eqNullSafe(q(other)), "left").drop(other)
    verdict = ~q(names["base_failed"]) & (q(names["host_low"]) <= host_limit)
    return judged.withColumn(names["kept"], verdict), names


def keep_documents(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``df`` that no rule rejects, with ``df``'s columns."""
    judged, names = apply_host_rules(df, text, host)
    return judged.where(q(names["kept"])).select(*[q(c) for c in df.columns])
