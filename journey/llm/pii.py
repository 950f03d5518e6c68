"""PII by bootstrapped contextual extraction.

Base detectors find seed entities.  Every seed, every other token with an at
mark (``@``, ``[at]``) and every other group of three or more digits, with the
spaces, brackets, dots and hyphens in it, touches two lexical patterns: the
word before it and the word after it, each with the value's coarse shape and
with its coarser form.  Spark scores the pattern-instance graph iteratively
(aggregates and joins over the small table of identifier-like occurrences,
never over the text), and patterns that stay confident add the unseen
identifiers they match.

Defined cases
    null or empty text: no spans.  Repeated rows and ids: each row is its own
    document (rows are numbered in a stored table).  Empty table: no patterns,
    empty result.  Overlapping kinds are all reported; within a kind matches
    never overlap.  Tokens longer than ``MAX_TOKEN`` code points are not taken
    as new identifiers (base spans have no such limit).
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journey.llm.common import map_rows, q, stored

# --- fixed values: the contract's base kinds in order, and the method's parameters
KINDS = ("email", "ip", "card", "phone")
MAX_TOKEN = 64
ROUNDS = 3
#: a pattern speaks for its instances from this score and this many distinct seed values
MIN_SCORE, MIN_SEEDS = 0.8, 5
# ---------------------------------------------------------------------------------

_EMAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AT = re.compile(r"@|\s?[\[({<]\s?(?i:at)\s?[\])}>]\s?")
_DELIMITERS = frozenset(",;:=|\"'`<>()[]{}")
# one space, dot, hyphen, slash or bracket between digits, or a space beside the last three
_BLANK = "[ \\t\u00a0\u2009\u202f]"
_GROUP = re.compile(rf"[0-9]++(?:(?:{_BLANK}?[-/(]{_BLANK}?|\)[-.]?{_BLANK}?|{_BLANK}|\.)[0-9]++)*+")
_SOLID = re.compile(r"\S+")
_GAP = re.compile(r"[^0-9]+")
_WORD = re.compile(r"\w+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base entities, sorted; linear in the text's length."""
    out, last = [], 0
    for m in _EMAIL.finditer(text) if "@" in text else ():
        # the match starts where the run of local characters before the @ starts
        s = m.start()
        while s > last and text[s - 1] in _LOCAL:
            s -= 1
        if s < m.start():
            out.append((s, 0, m.end()))
            last = m.end()
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_GAP.sub("", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def shape(value: str) -> str:
    """Coarse shape: the kinds of characters in it, 9 for digits, a for letters, others as they are, sorted."""
    return "".join(sorted({"9" if c.isdigit() else "a" if c.isalpha() else c for c in value}))


def form(value: str) -> str:
    """Coarser than ``shape``, without signs, brackets and separators: name with an at mark, else number."""
    return "name" if _AT.search(value) else "number"


def _neighbours(text: str, start: int, end: int) -> tuple[str, str]:
    left = _WORD.findall(text[max(0, start - MAX_TOKEN):start])
    right = _WORD.search(text[end:end + MAX_TOKEN])
    return (left[-1].lower() if left else "", right.group().lower() if right else "")


def _merged(spans) -> list[list[int]]:
    """The (start, end) pairs of ``spans``, merged where they overlap."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _names(text: str, covered: list[list[int]]):
    """(start, end) of tokens with an at mark that touch no covered span; every step is bounded by ``MAX_TOKEN``."""
    at, done = 0, 0
    for m in _AT.finditer(text):
        if m.start() < done:
            continue
        s, e = m.span()
        while s > done and m.start() - s <= MAX_TOKEN and not text[s - 1].isspace() and text[s - 1] not in _DELIMITERS:
            s -= 1
        while e < len(text) and e - m.end() <= MAX_TOKEN and not text[e].isspace() and text[e] not in _DELIMITERS:
            e += 1
        done = e
        while at < len(covered) and covered[at][1] <= s:
            at += 1
        if at < len(covered) and covered[at][0] < e:
            continue
        while e > m.end() and not text[e - 1].isalnum():
            e -= 1
        while s < m.start() and not text[s].isalnum():
            s += 1
        if s < m.start() and m.end() < e and e - s <= MAX_TOKEN:
            yield s, e


def _glued(text: str, inner: int, outer: int) -> bool:
    """Whether the digit at ``inner`` goes on beyond its group, of which ``outer`` is the next position outside."""
    if not 0 <= outer < len(text):
        return False
    if text[outer].isalnum() or text[outer] == "_":
        return True
    beyond = 2 * outer - inner
    if not 0 <= beyond < len(text):
        return False
    return text[beyond].isalnum() if text[outer] in "-/" else text[beyond].isdigit() and text[outer] in ",:"


def _numbers(text: str, start: int, end: int):
    """(start, end) of the groups of at least three digits in text[start:end], with their separators."""
    for m in _GROUP.finditer(text, start, end):
        tokens = [(t.start(), t.end()) for t in _SOLID.finditer(text, m.start(), m.end())]
        if _glued(text, m.end() - 1, m.end()):
            tokens.pop()
        if tokens and _glued(text, m.start(), m.start() - 1):
            tokens.pop(0)
        if not tokens:
            continue
        # numbers that are each as long as an identifier, or a row too long for one, count by token
        s, e = tokens[0][0], tokens[-1][1]
        split = e - s > MAX_TOKEN - 2 or all(len(_GAP.sub("", text[a:b])) >= 7 for a, b in tokens)
        for s, e in tokens if split else [(s, e)]:
            while s < e and not text[s].isdigit():
                s += 1
            while s < e and not text[e - 1].isdigit():
                e -= 1
            for _ in "+(":
                if s > start and (text[s - 1] == "+" or text[s - 1] == "(" and ")" in text[s:e]):
                    s -= 1
            if e - s <= MAX_TOKEN and len(_GAP.sub("", text[s:e])) >= 3:
                yield s, e


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Identifier-like occurrences: the base spans, other tokens with an at mark, other groups of digits.

    Seeds are of digits or hold an at mark, so no pattern could add any other token.
    """
    out = [(s, e, k) for s, k, e in base if e - s <= MAX_TOKEN]
    covered = _merged((s, e) for s, _, e in base)
    names = list(_names(text, covered))
    out += [(s, e, -1) for s, e in names]
    last = 0
    for s, e in [*_merged([*map(tuple, covered), *names]), [len(text), len(text)]]:
        out += [(a, b, -1) for a, b in _numbers(text, last, s)]
        last = e
    rows = []
    for s, e, k in out:
        left, right = _neighbours(text, s, e)
        rows.append({"start": s, "end": e, "kind": k, "value": text[s:e].lower(), "patterns": [
            f"{side} {f(text[s:e])}" for f in (shape, form) for side in (f"L {left}", f"R {right}")]})
    return rows


def label(spans, kinds=KINDS) -> str:
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)


SCAN = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "base array<struct<start:int,rank:int,label:string>>, "
        "occ array<struct<start:int,end:int,kind:int,value:string,patterns:array<string>>>")


def scan(df: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Base spans and identifier-like occurrences per row, numbered by ``row_`` and stored."""
    carried = df.select(*[q(c) for c in carry]).schema
    ddl = ", ".join(f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(carried)) + ", " + SCAN

    def rows(cols):
        got = {f"c{i}": cols[f"c{i}"] for i in range(len(carry))}
        for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "occ"):
            got[k] = []
        for t in cols["text_"]:
            t = t or ""
            base = base_spans(t)
            counts = [0] * len(KINDS)
            for _, k, _ in base:
                counts[k] += 1
            for name, n in zip(("n_email", "n_ip", "n_card", "n_phone"), counts, strict=True):
                got[name].append(n)
            got["base_sha256"].append(hashlib.sha256(label(base).encode()).hexdigest())
            got["base"].append([{"start": s, "rank": k, "label": f"{KINDS[k]}:{s}:{e}"} for s, k, e in base])
            got["occ"].append(occurrences(t, base))
        return got

    picked = df.select(*[q(c).alias(f"c{i}") for i, c in enumerate(carry)], q(text).cast("string").alias("text_"))
    found = map_rows(picked, rows, ddl)
    return stored(found.withColumn("row_", F.monotonically_increasing_id()), "pii-scan")


def confident_patterns(occ: DataFrame, rounds: int = ROUNDS, min_score: float = MIN_SCORE,
                       min_seeds: int = MIN_SEEDS) -> DataFrame:
    """(pattern, kind, score) of the patterns that may add identifiers.

    The graph's nodes are patterns and distinct values; a pattern's kind is
    the commonest of its seeds.  Seed values hold confidence 1 for their own kind
    and 0 for others.  Each round a pattern's score is the mean confidence of
    its values in its kind, and an unseeded value's confidence in a kind is the mean
    score of its patterns of that kind.  Each table is keyed by value or pattern and
    pre-aggregated, so a context with a third of all values is one row after
    the map side.  Iterations cut their lineage in the shared folder.
    """
    edges = occ.select(F.explode("patterns").alias("pattern"), "value", "kind")
    edges = stored(edges.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "pii-edges")
    seeds = edges.where("kind >= 0").groupBy("value").agg(F.max("kind").alias("seed"))
    kinds = edges.where("kind >= 0").groupBy("pattern").agg(
        F.count(F.lit(1)).alias("seeds"), F.mode("kind", True).alias("kind"))
    kinds = kinds.where(F.col("seeds") >= min_seeds).select("pattern", "kind")
    live = edges.drop("kind").join(kinds, "pattern").join(seeds, "value", "left")
    live = stored(live.select("pattern", "value", "kind", "seed"), "pii-live")
    sure = F.when(F.col("seed").isNotNull(), (F.col("seed") == F.col("kind")).cast("double"))
    score = live.groupBy("pattern").agg(F.avg(F.coalesce(sure, F.lit(0.0))).alias("score"))
    for _ in range(rounds):
        grown = live.where("seed IS NULL").join(score, "pattern").groupBy("value", "kind").agg(F.avg("score").alias("conf"))
        conf = stored(grown, "pii-conf")
        score = live.join(conf, ["value", "kind"], "left").groupBy("pattern").agg(
            F.avg(F.coalesce(sure, "conf", F.lit(0.0))).alias("score"))
    return score.join(kinds, "pattern").where(F.col("score") >= min_score).select("pattern", "kind", "score")


def extract(df: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), **params) -> DataFrame:
    """Carried columns, counts, digest and all spans (base and discovered) per row of ``df``."""
    found = scan(df, text, carry)
    occ = found.select("row_", F.explode("occ").alias("o")).select("row_", "o.*")
    best = confident_patterns(occ, **params)
    sides = occ.where("kind < 0").select("row_", "start", "end", F.explode("patterns").alias("pattern"))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    new = sides.join(best, "pattern").groupBy("row_", "start", "end").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    new = new.groupBy("row_").agg(F.collect_list(F.struct(
        F.col("start").cast("int").alias("start"), (F.col("kind") + len(KINDS)).cast("int").alias("rank"),
        F.concat(kind, F.lit("_context:"), "start", F.lit(":"), "end").alias("label"))).alias("new"))
    both = F.concat("base", F.coalesce("new", F.array().cast("array<struct<start:int,rank:int,label:string>>")))
    out = found.join(new, "row_", "left")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "n_email", "n_ip", "n_card", "n_phone",
                      "base_sha256", F.array_join(F.transform(F.array_sort(both), lambda x: x["label"]), ",").alias("spans"))
