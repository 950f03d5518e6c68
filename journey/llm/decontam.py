"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the benchmark's windows.  For each pattern length a shift
table over blocks of two words tells how far the window's end may jump; where
the shift is zero, a bucket keyed by a hash of the last words selects the
test strings, and direct comparison of all words confirms an occurrence.

The benchmark is cut into blocks of at most ``BLOCK`` windows.  Each block is
read to the driver, sent to the tasks, compiled once per task and
released after its pass over all documents, so what the driver and a worker hold at a
time has a fixed bound however many items there are.  The passes' hits are
stored tables, united per row.

Defined cases
    null or empty text: no words, never contaminated.  Null, empty or
    word-less items: no windows.  A null item id counts as the empty string.  Repeated windows and items: all items that
    hold the window are reported.  Repeated document rows: each row on its
    own.  Empty tables: no hits, or an empty result.
"""

from __future__ import annotations

import hashlib
import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journey.llm.common import map_rows, q, stored

# --- fixed values: the contract's window and the contamination rule ----------------
WINDOW = 13
MIN_SHARE = 20  # contaminated from one word in twenty
#: windows in one broadcast block: about 20 MB of words and tables at most
BLOCK = 20_000
#: words of a window's end that key the bucket
SUFFIX = 4
# -------------------------------------------------------------------------------------

_KEEP = (string.digits + string.ascii_lowercase).encode() + bytes(range(0x80, 0x100))
_FOLD = bytes(b if b in _KEEP else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: str | bytes | None) -> list[bytes]:
    """Words as UTF-8: A-Z lower-cased, other ASCII besides digits and a-z separates."""
    if not text:
        return []
    return (text if isinstance(text, bytes) else text.encode()).translate(_FOLD).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


class WuManber:
    """Shift tables and suffix buckets of a set of word patterns, one table per pattern length.

    Patterns of one word have no block of two words: they are looked up directly.
    """

    def __init__(self, patterns):
        by_length: dict[int, list[tuple[bytes, ...]]] = {}
        for p in set(patterns):
            by_length.setdefault(len(p), []).append(p)
        self.single = {p[0]: p for p in by_length.pop(1, [])}
        self.tables = []
        for m, group in sorted(by_length.items()):
            shift: dict[tuple[bytes, bytes], int] = {}
            buckets: dict[int, list[tuple[bytes, ...]]] = {}
            for p in group:
                for end in range(2, m + 1):
                    block = p[end - 2:end]
                    shift[block] = min(shift.get(block, m), m - end)
                buckets.setdefault(hash(p[-SUFFIX:]), []).append(p)
            self.tables.append((m, shift, buckets))

    def find(self, words: list[bytes]):
        """All occurrences as (start, pattern)."""
        if self.single:
            for i, w in enumerate(words):
                if w in self.single:
                    yield i, self.single[w]
        for m, shift, buckets in self.tables:
            end, n, skip = m, len(words), m - 1
            get = shift.get
            while end <= n:
                step = get((words[end - 2], words[end - 1]), skip)
                if step:
                    end += step
                    continue
                start = end - m
                for p in buckets.get(hash(tuple(words[max(start, end - SUFFIX):end])), ()):
                    if p[0] == words[start] and p == tuple(words[start:end]):
                        yield start, p
                end += 1


def pattern_table(items: DataFrame, item_id: str, text: str, block: int = BLOCK) -> tuple[DataFrame, int]:
    """Stored rows (block, window, item) of all windows, and the number of blocks.

    Rows are dealt to blocks by a hash of window and item, with a mean load
    of half of ``block``; a window that many items hold is spread as well.
    """
    def rows(cols):
        ids, wins = [], []
        for i, t in zip(cols["item"], cols["text_"], strict=True):
            for w in set(windows_of(words_of(t))):
                ids.append(i)
                wins.append(b" ".join(w))
        return {"item": ids, "window": wins}

    picked = items.select(F.coalesce(q(item_id).cast("string"), F.lit("")).alias("item"), q(text).cast("string").alias("text_"))
    wins = stored(map_rows(picked, rows, "item string, window binary").distinct(), "decontam-windows")
    n = wins.select(F.count(F.lit(1))).first()[0]
    blocks = max(1, -(-2 * n // block))
    return wins.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks))), blocks


def search(docs: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text",
           text: str = "text", carry: tuple[str, ...] = ("doc_id",), block: int = BLOCK) -> DataFrame:
    """Carried columns, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` per row.

    With one block (the usual case) a row is finished in the task that reads
    it, without a shuffle.  With more, the rows are numbered and stored, and each
    block's pass stores the rows it hits.
    """
    table, blocks = pattern_table(items, item_id, item_text, block)
    keys = [f"c{i}" for i in range(len(carry))]
    picked = docs.select(*[q(c).alias(k) for c, k in zip(carry, keys, strict=True)],
                         q(text).cast("string").alias("text_"))
    judge = _judge if blocks == 1 else _judge_by_blocks
    return judge(picked, keys, table, blocks).select(
        *[F.col(k).alias(c) for c, k in zip(carry, keys, strict=True)], "n_words", "n_hit", "n_items", "items_sha256",
        "contaminated")


def _load(table: DataFrame, block: int):
    """Broadcast of one block: the items of each window."""
    found: dict[bytes, list[str]] = {}
    for r in table.where(F.col("block") == block).select("window", "item").collect():
        found.setdefault(bytes(r["window"]), []).append(r["item"])
    return table.sparkSession.sparkContext.broadcast({tuple(w.split(b" ")): tuple(i) for w, i in found.items()})


def _finder(load):
    """``find(words)``: the places hit and the items found; the block is compiled at the first call in a task."""
    machine: list[WuManber] = []

    def find(words: list[bytes]) -> tuple[set[int], set[str]]:
        if not machine:
            machine.append(WuManber(load.value))
        hit: set[int] = set()
        ids: set[str] = set()
        for start, p in machine[0].find(words):
            hit.update(range(start, start + len(p)))
            ids.update(load.value[p])
        return hit, ids

    return find


def _judge(picked: DataFrame, keys: list[str], table: DataFrame, blocks: int) -> DataFrame:
    find = _finder(_load(table, 0))

    def rows(cols):
        got = {k: cols[k] for k in keys} | {k: [] for k in (
            "n_words", "n_hit", "n_items", "items_sha256", "contaminated")}
        for t in cols["text_"]:
            words = words_of(t)
            h, ids = find(words)
            got["n_words"].append(len(words))
            got["n_hit"].append(len(h))
            got["n_items"].append(len(ids))
            got["items_sha256"].append(hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest())
            got["contaminated"].append(bool(h) and MIN_SHARE * len(h) >= len(words))
        return got

    types = "".join(f"`{k}` {picked.schema[k].dataType.simpleString()}, " for k in keys)
    return map_rows(picked, rows, types + "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def _judge_by_blocks(picked: DataFrame, keys: list[str], table: DataFrame, blocks: int) -> DataFrame:
    """One pass for each block; a row that a pass hits is one row of its table, with at most a place for each word."""
    base = stored(picked.withColumn("row_", F.monotonically_increasing_id()), "decontam-rows")
    hits = None
    for b in range(blocks):
        load = _load(table, b)
        find = _finder(load)

        def rows(cols, find=find):
            got = {"row_": [], "hit": [], "ids": []}
            for r, t in zip(cols["row_"], cols["text_"], strict=True):
                hit, ids = find(words_of(t))
                if hit:
                    for k, v in (("row_", r), ("hit", sorted(hit)), ("ids", sorted(ids))):
                        got[k].append(v)
            return got

        found = stored(map_rows(base.select("row_", "text_"), rows, "row_ long, hit array<int>, ids array<string>"), "decontam-hits")
        load.destroy()
        hits = found if hits is None else hits.unionByName(found)
    united = [F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("hit", "ids")]
    hits = hits.groupBy("row_").agg(*united)

    def count(cols):
        return {k: cols[k] for k in ("row_", *keys)} | {"n_words": [len(words_of(t)) for t in cols["text_"]]}

    types = "".join(f"`{k}` {picked.schema[k].dataType.simpleString()}, " for k in keys)
    counted = map_rows(base, count, "row_ long, " + types + "n_words long").join(hits, "row_", "left")
    none = F.array().cast("array<string>")
    sized = counted.withColumn("n_hit", F.coalesce(F.array_size("hit"), F.lit(0)).cast("long"))
    ids = F.coalesce("ids", none)
    return sized.select(*keys, "n_words", "n_hit", F.array_size(ids).cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort(ids), ","), 256).alias("items_sha256"),
                        ((F.col("n_hit") > 0) & (MIN_SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text",
                    text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with its columns."""
    judged = search(docs, items, item_id, item_text, text, carry=tuple(docs.columns))
    return judged.toDF(*[f"c{i}" for i in range(len(docs.columns))], "a", "b", "c", "d", "dirty").where(
        "not dirty").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
