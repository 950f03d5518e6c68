"""Packing by shortest-pack-first over the length histogram.

Every text is tokenized once, in the task that reads it, into pieces of at
most ``CAPACITY`` ids; only lengths and checksums go on.  The histogram of piece
lengths (at most ``CAPACITY`` numbers) is packed on the driver: lengths
longest first, each into the packs with the most space left, as counts of
packing patterns.  Spark ranks the pieces within their length and the
patterns meet them by rank.

Ranks come from ``SALTS`` buckets per length, so a length that a third of all
documents share is ranked by many tasks; bucket offsets are a table of at most
``CAPACITY * SALTS`` rows, the only thing broadcast besides the patterns.

The patterns have a fixed bound whatever the number of documents.  Placing a
length adds three at most: one by a split, one of packs full of the length
and one of a pack with the rest.  The different lengths of a pattern sum to at most
``CAPACITY`` (C), so there are fewer than sqrt(2 C) of them, and a length stands
in a pattern twice at most.  That is below 6 C sqrt(2 C) slots of 32 bytes, 71 MB
for 4096; hard histograms give about 13,000 slots (0.4 MB).

Defined cases
    null or empty text: one piece holding the end id.  Repeated rows: packed
    each.  Null ids: packed, id null.  Empty table: empty result.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from journey.llm.common import map_rows, q, stored

# --- fixed values: the contract's sequence length and end id; the operator's parameters
CAPACITY = 4096
END_ID = 2
SALTS = 64
#: words, and parts of words, whose ids a worker remembers (about 100 MB)
REMEMBER = 400_000
# -----------------------------------------------------------------------------------------

# texts outside these characters, or with a special token's string, are encoded as a whole
_WHOLE = re.compile("[^\t\n\r\x20-\x7e\u00a1-\u024f]|<\\|(?:start|end)oftext\\|>")
# the splitting rule of the tokenizer file for which words are remembered
_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordEncoder:
    """Encodes texts with a ``tokenizers`` file, remembering words.

    Where the file lower-cases, splits by ``_RULE`` and so never joins ids
    across white space, the model is asked once for each new word; any other
    file, and texts with unusual characters, go through ``encode`` as a whole.
    """

    loaded: dict[str, WordEncoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        normal = [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])]
        split = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.by_word = (normal == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in split] == ["Split", "ByteLevel"]
                        and split[0]["pattern"] == {"Regex": _RULE} and split[0]["invert"]
                        and not split[1]["add_prefix_space"])
        self.model, self.bytes_of = self.tokenizer.model, ByteLevel(add_prefix_space=False, use_regex=False)
        self.parts = regex.compile(_RULE).findall
        self.words: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not self.by_word or _WHOLE.search(text):
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        get, out = self.words.get, []
        for w in text.split():
            ids = get(w)
            if ids is None:
                ids = self.word(w)
            out.append(ids)
        return b"".join(out)

    def word(self, word: str) -> bytes:
        low = word.lower()
        ids = self.token(low) if low.isalpha() else b"".join(map(self.token, self.parts(low)))
        if len(self.words) < REMEMBER:
            self.words[word] = ids
        return ids

    def token(self, part: str) -> bytes:
        ids = self.tokens.get(part)
        if ids is None:
            plain = part if part.isascii() else self.bytes_of.pre_tokenize_str(part)[0][0]
            ids = _packed([t.id for t in self.model.tokenize(plain)])
            if len(self.tokens) < REMEMBER:
                self.tokens[part] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def pieces_of(df: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
              capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of every piece, stored with a row number."""
    kind = df.select(q(doc_id)).schema[0].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def rows(cols):
        encoder = WordEncoder.of(tokenizer_path)
        got = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
        for d, t in zip(cols["doc_id"], cols["text_"], strict=True):
            ids = encoder.encode(t or "") + end
            n = len(ids) // 4
            for start in range(0, n, capacity):
                part = ids[4 * start:4 * (start + capacity)]
                for k, v in zip(got, (d, start, len(part) // 4, zlib.crc32(part), n), strict=True):
                    got[k].append(v)
        return got

    picked = df.select(q(doc_id).alias("doc_id"), q(text).cast("string").alias("text_"))
    out = map_rows(picked, rows, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")
    return stored(out.withColumn("row_", F.monotonically_increasing_id()), "pieces")


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as (number of packs, [(length, how many)]), shortest pack first.

    Lengths are placed longest first.  The group of equal packs with the most
    space takes the length, as many times as fits while pieces last; a group
    with more packs than there are pieces is split.
    """
    spaces: list[int] = []  # sorted
    groups: dict[int, list[tuple[int, tuple]]] = {}

    def put(space, n, pattern):
        if space not in groups:
            insort(spaces, space)
            groups[space] = []
        groups[space].append((n, pattern))

    def pop(space):
        group = groups[space].pop()
        if not groups[space]:
            del groups[space], spaces[bisect_left(spaces, space)]
        return group

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if spaces and spaces[-1] >= length:
                space = spaces[-1]
                n, pattern = pop(space)
                if n > left:
                    put(space, n - left, pattern)
                    n = left
            else:
                space, pattern = capacity, ()
                n = max(1, left // (capacity // length))
            times = max(1, min(space // length, left // n))
            put(space - times * length, n, (*pattern, (length, times)))
            left -= n * times
    return [(n, list(pattern)) for space in spaces for n, pattern in groups[space]]


def slots_of(patterns) -> dict[int, np.ndarray]:
    """Per length the rows (first rank, first sequence, offset, how many in a sequence), sorted by rank."""
    rank: dict[int, int] = {}
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for n, pattern in patterns:
        offset = 0
        for length, times in pattern:
            at = rank.get(length, 0)
            slots.setdefault(length, []).append((at, sequence, offset, times))
            rank[length] = at + n * times
            offset += length * times
        sequence += n
    return {k: np.array(v, np.int64) for k, v in slots.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, salts: int = SALTS) -> DataFrame:
    """``pieces`` (with ``row_`` and ``length``) with ``sequence_id`` and ``offset``."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("row_"), F.lit(salts)))
    sizes = stored(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "pack-sizes")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = pieces.sparkSession.sparkContext.broadcast(slots_of(pack_histogram(counts, capacity)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("length", "salt").orderBy("row_")
    ranked = salted.withColumn("rank", F.row_number().over(order)).join(F.broadcast(offsets), ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("first") - 1).drop("first", "salt", "row_")
    keep = [c for c in ranked.columns if c != "rank"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")

    def place(batches):
        for pdf in batches:
            seq, off = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            lengths, ranks = pdf["length"].to_numpy(), pdf["rank"].to_numpy()
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                table = slots.value[int(length)]
                at = np.searchsorted(table[:, 0], ranks[rows], "right") - 1
                first, sequence, offset, times = table[at].T
                seq[rows] = sequence + (ranks[rows] - first) // times
                off[rows] = offset + (ranks[rows] - first) % times * length
            yield pd.concat([pdf[keep], pd.DataFrame({"sequence_id": seq, "offset": off}, index=pdf.index)], axis=1)

    return ranked.mapInPandas(place, ddl + ", sequence_id long, offset long")


def pack_documents(df: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenize and pack all rows of ``df``: one row per piece."""
    return pack(pieces_of(df, tokenizer_path, doc_id, text))
