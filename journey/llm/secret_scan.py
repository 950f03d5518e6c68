"""Secret scans with an incremental ledger of blobs.

Every version of a text is addressed by the SHA-256 of its content.  Only
(blob, rule version) pairs that the ledger does not hold are scanned, one
text for each blob however many paths share it; the findings enter the ledger
as a new Parquet batch and are joined back to all paths.

The representatives are chosen on (blob, row) pairs without texts, then one
join on the row's id, which is unique and so never skewed, brings their texts.
The join back is on the blob against findings with one row for each blob;
AQE splits the paths' side where one blob is held by very many paths.

Defined cases
    null text: the empty blob, no findings.  Repeated rows, paths and ids: each
    row gets its blob's findings.  Empty tables: empty ledger batch and result.
    A rerun with the same rule version scans nothing; a new rule version scans
    every blob again.  A run that died before its batch was complete leaves
    no committed batch and is repeated in full.  Secrets have no upper length.
    A private key is all from its BEGIN marker to its END marker (header lines,
    escaped line ends and prefixes too); a BEGIN without an END is no finding.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from journey.llm.common import broadcast_checked, free_name, map_rows, q, stored

# --- fixed values: the contract's base kinds in order, then this scanner's own kinds
KINDS = ("assign", "access", "hex", "private_key", "jwt", "provider_token")
BASE = 3
RULE_VERSION = "1.1"
_ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_BEGIN = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
_END = re.compile(r"-----END [A-Z ]*PRIVATE KEY-----")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+")
_TOKEN = re.compile(r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+)")
# ---------------------------------------------------------------------------------------

LEDGER = "blob string, rule_version string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
FOUND = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")


def _key_blocks(text: str):
    """(start, end) of the private keys: each END marker with the last BEGIN marker since the END before it."""
    begins, last = _BEGIN.finditer(text), 0
    begin = next(begins, None)
    for end in _END.finditer(text):
        own = None
        while begin and begin.end() <= end.start():
            own, begin = begin if begin.start() >= last else own, next(begins, None)
        if own:
            yield own.start(), end.end()
        last = end.end()


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of all kinds, sorted; code points, end exclusive.

    An assignment of fewer than six value characters is dropped without a retry.
    """
    low = text.lower()
    out = []
    if any(k in low for k in ("passw", "secret", "token", "api_key", "apikey")):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        out += [(s, 3, e) for s, e in _key_blocks(text)]
    if "eyJ" in text:
        out += [(m.start(), 4, m.end()) for m in _JWT.finditer(text)]
    if "gh" in low or "xox" in low:
        out += [(m.start(), 5, m.end()) for m in _TOKEN.finditer(text)]
    out.sort()
    return out


def label(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan_rows(cols):
    got = {"blob": cols["blob"], "rule_version": cols["rule_version"], "n_assign": [], "n_access": [], "n_hex": [],
           "base_sha256": [], "spans": []}
    for t in cols["text_"]:
        spans = find_spans(t)
        for k, name in enumerate(("n_assign", "n_access", "n_hex")):
            got[name].append(sum(1 for x in spans if x[1] == k))
        got["base_sha256"].append(hashlib.sha256(label(x for x in spans if x[1] < BASE).encode()).hexdigest())
        got["spans"].append(label(spans))
    return got


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The committed ledger, empty where nothing was written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan_versions(versions: DataFrame, path_cols: tuple[str, ...], text: str, ledger: str,
                  rule_version: str = RULE_VERSION) -> DataFrame:
    """Scan the unseen blobs of ``versions``, append them to ``ledger``, return each row's findings.

    Result: ``path_cols`` (any columns that name the version), ``blob``, the
    counts, the digest of the base spans and all spans.  A column of the result
    whose name one of ``path_cols`` has already gets underscores behind it.

    Only blobs with findings join back to their paths; the other rows get the
    values of a blob without any, so a blob that a third of all rows hold costs
    a shuffle only where it has a secret.
    """
    spark = versions.sparkSession
    body = F.coalesce(q(text).cast("string"), F.lit(""))
    blob = free_name(list(versions.columns), "blob")
    name = F.coalesce(q(path_cols[0]).cast("string"), F.lit(""))
    # slim: every version's address, without texts
    paths = stored(versions.select(*[q(c) for c in path_cols], F.sha2(body, 256).alias(blob)), "secret-paths")
    seen = read_ledger(spark, ledger).where(F.col("rule_version") == rule_version).select("blob")
    slim = paths.select(q(blob).alias("blob"), name.alias("path"))
    reps = slim.join(seen, "blob", "left_anti").groupBy("blob").agg(F.min("path").alias("path"))
    # both sides are keyed by one version, so a blob with many paths is one row here
    full = versions.select(F.sha2(body, 256).alias("blob"), name.alias("path"), body.alias("text_"))
    todo = full.join(reps, ["blob", "path"], "left_semi").dropDuplicates(["blob", "path"])
    todo = todo.select("blob", F.lit(rule_version).alias("rule_version"), "text_")
    map_rows(todo, _scan_rows, LEDGER).write.mode("append").parquet(ledger)
    known = read_ledger(spark, ledger).where(F.col("rule_version") == rule_version)
    # a batch repeated after a crash may hold a blob twice
    hits = known.drop("rule_version").where("spans <> ''").dropDuplicates(["blob"])
    other = free_name(paths.columns, "blob_")
    none = {"spans": F.lit(""), "base_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    taken, columns = [*paths.columns, other], []
    for f in FOUND:
        taken.append(free_name(taken, f))
        columns.append((f, taken[-1]))
    hits = hits.select(F.col("blob").alias(other), *[F.col(f).alias(c) for f, c in columns])
    joined = paths.join(hits, q(blob) == q(other), "left")
    return joined.select(*[q(c) for c in paths.columns],
                         *[F.coalesce(q(c), none.get(f, F.lit(0).cast("long"))).alias(c) for f, c in columns])


def redact(text: str, spans: str, mark: str = "[SECRET]") -> str:
    """``text`` with every listed span replaced by ``mark``; overlapping spans become one mark."""
    out, at = [], 0
    for _, s, e in sorted((x.split(":") for x in spans.split(",")), key=lambda x: (int(x[1]), int(x[2]))):
        if int(s) >= at:
            out += [text[at:int(s)], mark]
        at = max(at, int(e))
    return "".join([*out, text[at:]])


def _redact_all(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([redact(t, s) if t is not None and s is not None else None for t, s in zip(text, spans, strict=True)],
                     dtype=object)


def redact_documents(docs: DataFrame, ledger: str, path: str = "doc_id", text: str = "text",
                     n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced by a mark (and ``n_chars``, where there, counted anew); no row is dropped.

    Only blobs with findings join back; rows without findings skip Python.
    """
    found = scan_versions(docs.select(q(path).alias("path"), q(text).alias("text")), ("path",), "text", ledger)
    names = [*docs.columns]
    key, blob, spans, clean = (names.append(free_name(names, n)) or names[-1] for n in ("key", "blob", "spans", "clean"))
    hits = found.where("spans <> ''").select(F.col("blob").alias(blob), F.col("spans").alias(spans)).dropDuplicates([blob])
    hits = broadcast_checked(stored(hits, "secret-hits"))  # few: texts do not move for them
    joined = docs.withColumn(key, F.sha2(F.coalesce(q(text).cast("string"), F.lit("")), 256)).join(hits, q(key) == q(blob), "left")
    redacted = F.pandas_udf(_redact_all, StringType())(F.when(q(spans).isNotNull(), q(text)), q(spans))
    joined = joined.withColumn(clean, redacted)
    hit = q(clean).isNotNull()
    new = {text: F.when(hit, q(clean)).otherwise(q(text))}
    if n_chars in docs.columns:
        new[n_chars] = F.when(hit, F.length(q(clean)).cast(docs.schema[n_chars].dataType)).otherwise(q(n_chars))
    return joined.select(*[new.get(c, q(c)).alias(c) for c in docs.columns])
