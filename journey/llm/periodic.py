"""Periodic runs of words by a dictionary of basic factors.

For every power of two L the factors of L words get names (pairs of the names of
their halves).  Successor occurrences of one factor at most L / 2 apart form
arithmetic progressions: their difference is the factor's own period.  A run
of period q, L <= q < 2 L, starts at an occurrence of a factor that is there
again q words later.  Where the first stretch of the factor's own period
breaks before that, q is the distance of the last members of two
progressions, otherwise the distance of the start and the first member of the later
one; progressions less than 2 L apart therefore propose every period.  Proposals
are extended to both sides by the same dictionary and deduplicated: equal
stretches keep their smallest period.

A text of n words costs n log n names and O(log n) vector steps for each power;
levels end with the first power at which no factor comes again.  Texts are
independent of each other: one pass over the rows, no shuffle, and a lost
task computes its rows again.

Defined cases
    null, empty or blank text: no words, no run.  A text of one word, or of fewer
    than ``MIN_LENGTH``: no run.  Repeated rows: each on its own.  Null ids and
    further columns: carried.  Empty table: empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from journey.llm.common import give_back, q, slices

#: words in a run at least, besides two periods; by contract
MIN_LENGTH = 12
RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def names_of(ids: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of 1, 2, 4, .. words, by start, as long as some factor comes again.

    Equal factors have equal names; names of different lengths are unrelated.
    """
    levels, length = [], 1
    while True:
        if length == 1:
            key = ids
        else:
            low = levels[-1]
            if len(low) <= length // 2:
                return levels
            key = low[:len(low) - length // 2].astype(np.int64) * (int(low.max()) + 1) + low[length // 2:]
        seen, name = np.unique(key, return_inverse=True)
        if len(seen) == len(key):
            return levels
        levels.append(name.astype(np.int32))
        length *= 2


def _forward(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from ``i`` and from ``j`` on are equal (i < j)."""
    i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        name, size = levels[k], 1 << k
        go = np.ones(len(i), bool)
        while go.any():  # more than one step only at the highest level
            at = np.flatnonzero(go & (j < len(name)))
            same = at[name[i[at]] == name[j[at]]]
            go[:] = False
            go[same] = k == len(levels) - 1
            i[same] += size
            j[same] += size
            total[same] += size
    return total


def _backward(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words that end before ``i`` and before ``j`` are equal (i < j)."""
    i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        name, size = levels[k], 1 << k
        go = np.ones(len(i), bool)
        while go.any():
            at = np.flatnonzero(go & (i >= size))
            same = at[name[i[at] - size] == name[j[at] - size]]
            go[:] = False
            go[same] = k == len(levels) - 1
            i[same] -= size
            j[same] -= size
            total[same] += size
    return total


def _proposals(name: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) proposed by the progressions of the factors of ``size`` words."""
    at = np.argsort(name, kind="stable")
    key = name[at]
    new = np.ones(len(at), bool)  # a new progression begins
    new[1:] = (key[1:] != key[:-1]) | (2 * (at[1:] - at[:-1]) > size)
    which = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    kind = key[first]
    where, period = [], []

    def propose(i, p):
        good = (p >= size) & (p < 2 * size)
        where.append(i[good])
        period.append(p[good])

    for step in (1, 2, 3):  # later ones are 2 * size words away at least
        ok = np.zeros(len(first), bool)
        ok[:-step or None] = kind[:-step] == kind[step:] if step < len(kind) else False
        pairs = np.flatnonzero(ok)
        if not len(pairs):
            break
        propose(at[last[pairs]], at[last[pairs + step]] - at[last[pairs]])
        members = np.flatnonzero(ok[which])
        propose(at[members], at[first[which[members] + step]] - at[members])
    if not where:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i, p = np.concatenate(where), np.concatenate(period)
    order = np.lexsort((i, p))
    i, p = i[order], p[order]
    keep = np.ones(len(i), bool)  # the next position with the same period lies in the same run
    keep[1:] = (p[1:] != p[:-1]) | (i[1:] - i[:-1] > size)
    return i[keep], p[keep]


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all maximal runs of ``max(min_length, 2 * period)`` words or more, by start, then period."""
    none = np.empty(0, np.int64)
    if len(ids) < 2:
        return none, none, none
    levels = names_of(ids)
    found = [_proposals(name, 1 << k) for k, name in enumerate(levels)]
    if not sum(len(i) for i, _ in found):
        return none, none, none
    i = np.concatenate([f[0] for f in found]).astype(np.int64)
    p = np.concatenate([f[1] for f in found]).astype(np.int64)
    start = i - _backward(levels, i, i + p)
    end = i + p + _forward(levels, i, i + p)
    good = end - start >= np.maximum(min_length, 2 * p)
    start, end, p = start[good], end[good], p[good]
    order = np.lexsort((p, end, start))
    start, end, p = start[order], end[order], p[order]
    keep = np.ones(len(p), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, p = start[keep], end[keep], p[keep]
    order = np.lexsort((p, start))
    return start[order], (end - start)[order], p[order]


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:n]) == 0


def split_words(row: dict) -> list[bytes]:
    """The words of a row's text: what lies between ASCII white space, as UTF-8."""
    return (row["text_"] or b"").split()


def runs(df: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), words=split_words,
         min_length: int = MIN_LENGTH) -> DataFrame:
    """Carried columns, ``n_words``, ``runs`` (all, by start, then period) and the ``collapsed`` text of every row.

    The collapsed text holds the words that no run repeats, joined by one
    space.  ``words`` gives the words of a row from the dictionary of its
    carried columns and ``text_``.  The carried columns must not have names of
    the result.
    """
    result = StructType.fromDDL(RESULT)
    clash = {c.lower() for c in carry} & {f.name for f in result}
    if clash:
        raise ValueError(f"carried columns {sorted(clash)} have names of the result")
    keys = [f"c{i}" for i in range(len(carry))]
    picked = df.select(*[q(c).alias(k) for c, k in zip(carry, keys, strict=True)], q(text).cast("binary").alias("text_"))
    schema = StructType(picked.schema.fields[:-1] + result.fields)
    out = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                columns = [part.column(i).to_pylist() for i in range(part.num_columns)]
                got, offsets, n_words, collapsed = [], [0], [], []
                for values in zip(*columns, strict=True):
                    row = dict(zip((*carry, "text_"), values, strict=True))
                    said = words(row)
                    number: dict[bytes, int] = {}
                    ids = np.fromiter((number.setdefault(w, len(number)) for w in said), np.int64, len(said))
                    found = find_runs(ids, min_length)
                    got.append(found)
                    offsets.append(offsets[-1] + len(found[0]))
                    n_words.append(len(said))
                    if len(found[0]):
                        said = [said[i] for i in np.flatnonzero(kept_words(len(said), *found))]
                    collapsed.append(b" ".join(said).decode("utf-8", "replace"))
                three = [pa.array(np.concatenate(x) if x else np.empty(0, np.int64)) for x in zip(*got, strict=True)]
                spans = pa.StructArray.from_arrays(three, ["start", "length", "period"])
                arrays = [part.column(i) for i in range(len(carry))]
                arrays += [pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
                           pa.array(collapsed, pa.string())]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, out, strict=True)], schema=out)
        give_back()

    done = picked.mapInArrow(run, schema)
    return done.toDF(*carry, *[f.name for f in result])
