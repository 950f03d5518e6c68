"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Two tokenizers cut the same bytes.  Every interval of tokens between two common
ends is halved at a common end near its middle token, looked for by bisection
among the other side's ends, outwards from the middle; both halves go on.  An
interval without a common end inside is a leaf: one group of tokens.  The
intervals of many pieces are halved side by side, one vector step a round.

Where the tokenizers' own rules forbid any token to cross (``Aligner.pieces``),
a common end needs no search: texts are divided there first, and what a piece
gives is its share of every text that has it.  Pieces are tokenized and aligned
once as long as a worker's bounded memory has room; long ones, and texts that
have no such place or a piece that is not given back, are read whole each time.

Tokens whose byte ranges overlap are linked.  How often two ids are linked is
counted over all texts:

1. One pass tokenizes and aligns.  A task gathers its rows into chunks of at
   most ``CHUNK_LINKS`` links and writes the rows, each with its distinct id pairs, and one
   row a chunk with the chunk's pairs and their counts.
2. Counts are summed by pair over the chunks (summed inside a chunk before any
   shuffle) and the highest count of every id of the second side is taken.
3. The totals join the chunks' pairs and meet the chunk's rows again in one
   bounded group a chunk.

No dictionary of pairs is collected or broadcast.  Chunks are written tables in
the shared folder, so a lost executor costs the tasks that it ran.

Defined cases
    null or empty text, or a text that one of the tokenizers does not give back
    byte by byte: no tokens, numbers of zero, groups ''.  Repeated rows: each on
    its own, and counted each.  Null ids and further columns: carried.  Empty
    table: empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from journey.llm import encoders
from journey.llm.common import give_back, q, shared_dir
from journey.llm.encoders import Encoder
from journey.llm.token_counts import byte_ranges

# --- the operator's parameters -----------------------------------------------------------------
#: links in one chunk, unless one row alone has more
CHUNK_LINKS = 4_000_000
#: bytes of text aligned in one vector step, one text at least
SLICE_BYTES = 1 << 20
# ------------------------------------------------------------------------------------------------

STATS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
#: an id pair is one number: first id times this, plus the second
SIDE = 1 << 31

#: the space mark of ``sentencepiece``
MARK = "▁"
_UNEVEN = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= +[^ ])")


def byte_table(encoder: Encoder) -> list[bytes]:
    """The bytes of every id of a byte-level ``tokenizers`` file or a ``sentencepiece`` model with byte fallback."""
    if encoder.model:
        lib, out = encoder.library, []
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece) if lib.is_byte(i) else None
            out.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        return out
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    vocab = json.loads(encoder.library.to_str())["model"]["vocab"]
    out = [b""] * (1 + max(vocab.values()))
    for entry, i in vocab.items():
        out[i] = bytes(back[c] for c in entry) if all(c in back for c in entry) else entry.encode()
    return out


def cut_groups(ends_a: np.ndarray, ends_b: np.ndarray, bounds_a: np.ndarray) -> np.ndarray:
    """Last tokens of the first side of all groups, sorted.

    ``ends_a`` and ``ends_b`` are the tokens' end bytes, rising.  ``bounds_a`` are the
    token numbers where texts end (exclusive): common ends that hold a last
    token each.
    """
    low = np.append(0, bounds_a[:-1])[bounds_a > np.append(0, bounds_a[:-1])]
    high = bounds_a[bounds_a > np.append(0, bounds_a[:-1])] - 1  # inside: tokens low .. high - 1
    cuts = [high]
    while len(low):
        inside = low < high
        low, high = low[inside], high[inside]
        middle = (low + high - 1) // 2
        where = np.full(len(low), -1, np.int64)
        left, step = np.arange(len(low)), 0
        while len(left):  # outwards from the middle: 0, +1, -1, +2, ..
            distance = (step + 1) // 2
            probe = middle[left] + (distance if step % 2 else -distance)
            ok = (probe >= low[left]) & (probe < high[left])
            at = left[ok]
            ends = ends_a[probe[ok]]
            hit = ends_b[np.searchsorted(ends_b, ends)] == ends
            where[at[hit]] = probe[ok][hit]
            both = (middle[left] - distance < low[left]) & (middle[left] + distance >= high[left])
            left = left[(where[left] < 0) & ~both]
            step += 1
        found = where >= 0
        cut = where[found]
        cuts.append(cut)
        low, high = np.concatenate([low[found], cut + 1]), np.concatenate([cut, high[found]])
    return np.sort(np.concatenate(cuts))


class Aligner:
    """Both tokenizers in one worker; the first reads a space and the text, the second adds the space by itself.

    Numbers, groups and links of pieces are remembered, a bounded number of them.
    """

    loaded: dict[tuple[str, str], Aligner] = {}

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Encoder.of(path_a, plain=True), Encoder.of(path_b, plain=True)
        tables = [byte_table(e) for e in (self.a, self.b)]
        self.bytes_of = [np.array([*t, None], object)[:-1] for t in tables]
        self.sizes = [np.array([len(x) for x in t], np.int64) for t in tables]
        # an id as it is written inside and at the end of its side of a group
        self.said = [np.array([f"{i}{mark}".encode() for mark in marks for i in range(len(t))], object)
                     for t, marks in zip(tables, (",|", ",;"), strict=True)]
        #: whether no token of either side crosses the cuts of ``pieces``
        self.cuts = self.a.cuts and not self.a.model and self.b.cuts and self.b.model
        self.forget()

    @classmethod
    def of(cls, path_a: str, path_b: str) -> Aligner:
        if (path_a, path_b) not in cls.loaded:
            cls.loaded[path_a, path_b] = cls(path_a, path_b)
        return cls.loaded[path_a, path_b]

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        # of each remembered piece: n_a, n_b, n_groups, n_links; its groups; where its links begin among the links of all
        self.numbers, self.groups, self.first = np.empty((4, 0), np.int64), [], np.empty(0, np.int64)
        self.links = np.empty(0, np.int64)
        self.a.known.clear()
        self.b.known.clear()

    def pieces(self, text: str) -> list[str]:
        """The text cut where both sides end a token: before a space that follows a character which is not white space.

        Pieces come without their first space, the text as if it had one more before it.
        """
        if not text or not self.cuts or MARK in text:
            return [text] if text else []
        if _UNEVEN.search(text) is None and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [p[1:] for p in _CUT.split(" " + text)]

    def align(self, texts: list[str]):
        """Arrays by text (n_a, n_b, n_groups, n_links), the groups of each text as bytes, and the pairs of all links in order.

        A pair is the first id times the size of the second vocabulary, plus the second id.
        """
        pieces = [self.pieces(t) for t in texts]
        at, long = self._places(pieces)
        stop = np.cumsum([len(p) for p in pieces])
        lost = np.unique(np.searchsorted(stop, np.flatnonzero(self.numbers[0, at] == 0), "right"))
        lost = [i for i in lost.tolist() if len(pieces[i]) > 1]
        if lost:  # a piece is not given back: the whole text decides
            for i in lost:
                pieces[i] = [texts[i]]
            self._drop(long)
            at, long = self._places(pieces)
            stop = np.cumsum([len(p) for p in pieces])
        numbers = self.numbers[:, at]
        n_links = numbers[3]
        pairs = self.links[np.repeat(self.first[at] - np.cumsum(n_links) + n_links, n_links) + np.arange(n_links.sum())]
        run = np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(numbers, axis=1)], axis=1)
        given, at, stop = self.groups, at.tolist(), np.append(0, stop).astype(np.int64)
        said = [b"".join([given[i] for i in at[x:y]])[:-1] for x, y in itertools.pairwise(stop.tolist())]
        self._drop(long)
        return *np.diff(run[:, stop], axis=1), said, pairs

    def _places(self, pieces: list[list[str]]) -> tuple[np.ndarray, list[str]]:
        """The places of all pieces, in order; and the long ones, to be dropped after use."""
        every = list(chain.from_iterable(pieces))
        at = np.fromiter(map(self.place.get, every, repeat(-1)), np.int64, len(every))
        new = np.flatnonzero(at < 0).tolist()
        if not new:
            return at, []
        missing = dict.fromkeys([every[i] for i in new])
        if len(self.place) + len(missing) + (len(self.a.known) + len(self.b.known)) // 2 > encoders.REMEMBER:
            self.forget()
            new, missing = range(len(every)), dict.fromkeys(every)
        long = [p for p in missing if len(p) > encoders.REMEMBER_CHARS]
        self._learn(*self._short([p for p in missing if len(p) <= encoders.REMEMBER_CHARS]))
        if long:
            given = ([" " + p for p in long], long)
            read = [e.ids(g) for e, g in zip((self.a, self.b), given, strict=True)]
            self._learn(long, *[x for r in read for x in (np.frombuffer(b"".join(r), "<u4").astype(np.int64),
                                                          np.array([len(b) // 4 for b in r], np.int64))])
        at[new] = [self.place[every[i]] for i in new]
        return at, long

    def _drop(self, long: list[str]) -> None:
        """Forget the long pieces, which were learned last."""
        if long:
            n = len(self.place) - len(long)
            self.links = self.links[:self.first[n]].copy()
            self.numbers, self.first = self.numbers[:, :n].copy(), self.first[:n].copy()
            del self.groups[n:]
            for p in long:
                del self.place[p]

    def _short(self, pieces: list[str]):
        """The pieces, and for each side their ids in a row and how many each has."""
        # those that a space may follow come first: the first side reads them as one text
        even = [p for p in pieces if self.cuts and not p[-1].isspace()]
        rest = [p for p in pieces if not self.cuts or p[-1].isspace()]
        a, n_a = self._together([" " + p for p in even])
        one_by_one = [ids for _, ids in self.a.encode([" " + p for p in rest])]
        second = [ids for _, ids in self.b.encode(even + rest)]
        return (even + rest, np.concatenate([a, _flat(one_by_one)]), np.append(n_a, list(map(len, one_by_one))).astype(np.int64),
                _flat(second), np.array(list(map(len, second)), np.int64))

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the first side; it ends a token at the end of each piece, and the tokens' bytes tell where that is."""
        read = [self.a.library.encode_batch_fast(["".join(b)], add_special_tokens=False)[0].ids for b in self.a.batches(pieces)]
        ids = _flat(read)
        ends = np.append(0, np.cumsum(self.sizes[0][ids]))
        whole = [p.encode("utf-8", "replace") for p in pieces]
        stop = np.append(0, np.cumsum([len(w) for w in whole])).astype(np.int64)
        at = np.searchsorted(ends, stop, "right") - 1
        if np.array_equal(ends[at], stop) and self._back(0, ids) == b"".join(whole):
            return ids, np.diff(at)
        read = [x for _, x in self.a.encode(pieces)]  # not the same bytes
        return _flat(read), np.array(list(map(len, read)), np.int64)

    def _back(self, side: int, ids: np.ndarray) -> bytes:
        return b"".join(self.bytes_of[side][ids].tolist())

    def _learn(self, pieces: list[str], a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> None:
        """Align the pieces and remember them; all numbers are zero where a side does not give back the bytes."""
        if not pieces:
            return
        whole = [b" " + p.encode("utf-8", "replace") for p in pieces]
        size, both = np.array([len(w) for w in whole], np.int64), b"".join(whole)
        ids, n, ok = [a, b], [n_a, n_b], np.ones(len(pieces), bool)
        for s in (0, 1):  # the same bytes, and cut alike: every piece is given back
            run = np.append(0, np.cumsum(self.sizes[s][ids[s]]))[np.append(0, np.cumsum(n[s]))]
            if not np.array_equal(np.diff(run), size) or self._back(s, ids[s]) != both:
                stop = np.cumsum(n[s])
                ok &= [self._back(s, ids[s][y - k:y]) == w for y, k, w in zip(stop.tolist(), n[s].tolist(), whole, strict=True)]
        if not ok.all():
            a, b = a[np.repeat(ok, n_a)], b[np.repeat(ok, n_b)]
            n_a, n_b = n_a * ok, n_b * ok
        numbers, groups, links = self._aligned(a, n_a, b, n_b)
        self.place.update(zip(pieces, range(len(self.place), len(self.place) + len(pieces)), strict=True))
        self.first = np.append(self.first, len(self.links) + np.cumsum(numbers[3]) - numbers[3])
        self.numbers = np.concatenate([self.numbers, numbers], axis=1)
        self.links = np.append(self.links, links)
        self.groups += groups

    def _aligned(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray):
        """Four numbers of each piece, its groups as bytes with a ';' at the end, and the pairs of all links in order."""
        if not len(a):
            return np.zeros((4, len(n_a)), np.int64), [b""] * len(n_a), np.empty(0, np.int64)
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        last_a = cut_groups(ends_a, ends_b, np.cumsum(n_a))
        last_b = np.searchsorted(ends_b, ends_a[last_a])
        # between two ends of any side lies one link
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        ends = ends[np.append(True, ends[1:] != ends[:-1])]
        pairs = a[np.searchsorted(ends_a, ends)] * len(self.sizes[1]) + b[np.searchsorted(ends_b, ends)]
        stop = np.cumsum(n_a)
        where = np.append(0, ends_a)[stop]  # bytes before each piece's end
        n_links = np.diff(np.searchsorted(ends, where, "right"), prepend=0)
        n_groups = np.diff(np.searchsorted(last_a, stop - 1, "right"), prepend=0)
        n_groups[n_a == 0] = 0
        return np.stack([n_a, n_b, n_groups, n_links]), self._groups(a, b, last_a, last_b, stop, np.cumsum(n_b)), pairs

    def _groups(self, a, b, last_a, last_b, stop_a, stop_b) -> list[bytes]:
        """The groups of each piece: ids joined by commas, the sides by '|', a ';' behind each group."""
        # a token's place in the piece: behind the other side's tokens of the groups before its own, or up to it
        in_a = np.zeros(len(a) + 1, np.int64)
        in_a[last_a + 1] = np.diff(last_b + 1, prepend=0)
        in_b = np.zeros(len(b) + 1, np.int64)
        in_b[0] = last_a[0] + 1
        in_b[last_b[:-1] + 1] = np.diff(last_a)
        said = np.empty(len(a) + len(b), object)
        end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        end_a[last_a], end_b[last_b] = len(self.sizes[0]), len(self.sizes[1])
        said[np.arange(len(a)) + np.cumsum(in_a[:-1])] = self.said[0][a + end_a]
        said[np.arange(len(b)) + np.cumsum(in_b[:-1])] = self.said[1][b + end_b]
        at, said = (stop_a + stop_b).tolist(), said.tolist()
        return [b"".join(said[x:y]) for x, y in zip([0, *at[:-1]], at, strict=True)]


def _flat(lists) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and how often each is there."""
    keys = np.sort(keys)
    start = np.flatnonzero(np.append(np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]))
    return keys[start], np.diff(np.append(start, len(keys)))


def align_rows(df: DataFrame, path_a: str, path_b: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",),
               groups: bool = False, chunk_links: int = CHUNK_LINKS) -> str:
    """Writes the aligned rows (folder ``kind=row``) and chunks (``kind=chunk``) to the shared folder and returns its path.

    Both have ``chunk``, ``pairs`` and ``times``; rows also ``c0``, ``c1``, .. (the carried
    columns), the numbers and, with ``groups``, the groups as text.
    """
    keys = [f"c{i}" for i in range(len(carry))]
    picked = df.select(*[q(c).alias(k) for c, k in zip(carry, keys, strict=True)], q(text).cast("binary").alias("text_"))
    more = StructType.fromDDL(f"{STATS}, groups string, kind string, chunk long, pairs array<long>, times array<int>")
    schema = StructType(picked.schema.fields[:-1] + more.fields)
    for f in schema.fields:
        f.nullable = True
    out = to_arrow_schema(schema)

    def run(batches):
        aligner = Aligner.of(path_a, path_b)
        second = len(aligner.sizes[1])
        base, chunk, held, links = TaskContext.get().partitionId() << 32, 0, [], 0

        def close():
            seen, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            n = np.bincount(at, np.concatenate([h[1] for h in held]), len(seen)).astype(np.int64)
            given = {"kind": pa.array(["chunk"]), "chunk": pa.array([base + chunk], pa.int64()),
                     "pairs": pa.array([seen // second * SIDE + seen % second], pa.list_(pa.int64())),
                     "times": pa.array([n.astype(np.int32)], pa.list_(pa.int32()))}
            return pa.RecordBatch.from_arrays(
                [given[f.name].cast(f.type) if f.name in given else pa.nulls(1, f.type) for f in out], schema=out)

        for batch in batches:
            raw = batch.column(batch.num_columns - 1)
            sizes = [n or 0 for n in pa.compute.binary_length(raw).to_pylist()]
            for first, end in byte_ranges(sizes, SLICE_BYTES):
                texts = [(t or b"").decode("utf-8", "replace") for t in raw.slice(first, end - first).to_pylist()]
                n_a, n_b, n_groups, n_links, said, pairs = aligner.align(texts)
                # the distinct pairs of each text and how often it has them
                size = len(aligner.sizes[0]) * second
                key, times = counted(np.repeat(np.arange(len(texts)) * size, n_links) + pairs)
                of, key = np.divmod(key, size)
                each = np.append(0, np.cumsum(np.bincount(of, minlength=len(texts))))
                total = int(n_links.sum())
                if links and links + total > chunk_links:
                    yield close()
                    chunk, held, links = chunk + 1, [], 0
                held.append(counted(pairs))
                links += total
                pairs = key // second * SIDE + key % second
                if len(held) > 8:  # one table of distinct pairs, so that memory follows them and not the rows
                    both, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
                    held = [(both, np.bincount(at, np.concatenate([h[1] for h in held]), len(both)))]
                n = end - first
                given = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
                         "groups_sha256": [hashlib.sha256(s).hexdigest() if s else "" for s in said],
                         "groups": [s.decode() for s in said] if groups else [None] * n, "kind": ["row"] * n, "chunk": [base + chunk] * n}
                part = batch.slice(first, n)
                columns = [part.column(i) for i in range(len(carry))]
                columns += [pa.array(given[f.name], f.type) for f in list(out)[len(carry):-2]]
                columns += [pa.ListArray.from_arrays(pa.array(each, pa.int32()), pa.array(v)) for v in (pairs, times.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out, strict=True)], schema=out)
        if held:
            yield close()
        give_back()

    path = shared_dir(df.sparkSession, "alignment")
    picked.mapInArrow(run, schema).write.partitionBy("kind").parquet(path)
    return path


def link_counts(chunks: DataFrame) -> DataFrame:
    """(pair, n, best) of the whole corpus from the chunks' counts; ``best``: no pair with its second id has more links."""
    pair = chunks.select(F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    total = pair.groupBy("pair").agg(F.sum(F.col("times").cast("long")).alias("n"))
    same = Window.partitionBy(F.pmod("pair", F.lit(SIDE)))  # bounded: the first tokenizer's vocabulary
    return total.withColumn("best", F.col("n") == F.max("n").over(same))


def score_links(rows: DataFrame, chunks: DataFrame, totals: DataFrame) -> DataFrame:
    """``rows`` without pairs, with ``n_best`` and ``count_sum``: one bounded group a chunk."""
    looked = chunks.select("chunk", F.explode("pairs").alias("pair")).join(totals, "pair")
    keep = [f for f in rows.schema.fields if f.name not in ("chunk", "pairs", "times", "kind")]
    schema = StructType([*keep, *StructType.fromDDL("n_best long, count_sum long").fields])
    out = to_arrow_schema(schema)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        pair = right.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, n = pair[order], right.column("n").to_numpy()[order]
        best = right.column("best").to_numpy(zero_copy_only=False)[order]
        left = left.combine_chunks()
        sums = [np.zeros(left.num_rows, np.int64), np.zeros(left.num_rows, np.int64)]
        if len(pair):
            lists = left.column("pairs").combine_chunks()
            times = left.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
            at = np.searchsorted(pair, lists.flatten().to_numpy())
            size = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            edge = np.append(0, np.cumsum(size))
            for k, v in enumerate((times * best[at], times * n[at])):
                run = np.append(0, np.cumsum(v))
                sums[k] = run[edge[1:]] - run[edge[:-1]]
        columns = [left.column(f.name).cast(out.field(f.name).type) for f in keep]
        return pa.Table.from_arrays([*columns, *[pa.array(s, pa.int64()) for s in sums]], schema=out)

    return rows.groupBy("chunk").cogroup(looked.groupBy("chunk")).applyInArrow(score, schema)


def align(df: DataFrame, path_a: str, path_b: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",),
          groups: bool = False) -> DataFrame:
    """Carried columns, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, ``n_best``, ``count_sum`` of every row.

    ``groups=True`` adds the groups as text.  The carried columns must not have names of the result.
    """
    names = [f.name for f in StructType.fromDDL(STATS)] + (["groups"] if groups else []) + ["n_best", "count_sum"]
    clash = {c.lower() for c in carry} & set(names)
    if clash:
        raise ValueError(f"carried columns {sorted(clash)} have names of the result")
    spark = df.sparkSession
    path = align_rows(df, path_a, path_b, text, carry, groups)
    rows, chunks = (spark.read.schema(_written(df, carry)).parquet(path).where(F.col("kind") == k) for k in ("row", "chunk"))
    chunks = chunks.select("chunk", "pairs", "times")
    if not groups:
        rows = rows.drop("groups")
    return score_links(rows, chunks, link_counts(chunks)).toDF(*carry, *names)


def _written(df: DataFrame, carry) -> StructType:
    fields = df.select(*[q(c).alias(f"c{i}") for i, c in enumerate(carry)]).schema.fields
    more = StructType.fromDDL(f"{STATS}, groups string, chunk long, pairs array<long>, times array<int>, kind string")
    return StructType([*fields, *more.fields])
