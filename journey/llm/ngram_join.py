"""N-gram Jaccard join by prefix filters under several global token orders.

Texts become sets of 64-bit shingle hashes; equal sets form a class, and one
class is one node however many copies it has.  Under a global order of tokens
two sets of similarity t share a token among the first ``n - ceil(t n) + 1``
of each, whatever the order is.  Three orders are used.  The first deals out the
candidates: shingles with a rare word come first, then the others by their
rarest word's count, and shingles that many documents hold come last, so that
chance phrases and shared lines rarely stand in a prefix.  A candidate pair must also share tokens of the prefixes under
the second and the third order, as many as ``least_shared`` says two similar
sets always do; they are counted on 16-bit fingerprints, with what a set loses
to equal fingerprints allowed for, so no pair is lost.  Only the classes of
candidate pairs and of long lists get their texts read again, for their
fingerprints and bitmaps; only the sets of pairs that pass all three orders
and the bitmaps are made, from their texts, and compared.

Where only the components are asked for, a long list of classes that share a
token is not expanded into all pairs.  Lists of at most ``SMALL`` classes are.  In
longer ones all members are first compared with one typical member (``pivot``);
then, in lists that still hold several components, the members outside the
largest one are compared with more of its members; at last every pair of one
list whose sides are still in different components is considered.  There the
join's condition holds thin parity bitmaps against each other, whose differing
bits are at most as many as the tokens that differ, so it puts out few pairs
that are not links.  That last step is exact: every pair that passes the prefix
filter was compared, is too far apart by its bitmaps, or lies within one
component already.

Where links are counted (``links``), every pair of a long list that the filters
and the bitmaps let pass is compared, also within one component; the links of two
classes count for all their rows.

What is broadcast: the ``MAX_HEAVY`` most frequent tokens and ``MAX_WORDS`` most
frequent words, which only order the tokens (any order gives the same links),
and ids and keys behind a check of their size.

Defined cases
    null, empty or word-less text: empty set, linked with nothing, its own
    component.  Fewer words than the shingle size: the whole sequence is one
    shingle.  Repeated rows: the same class.  Null ids: members of their class
    without giving it a name; a component without any id is null.  Empty
    table: empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from journey.llm.common import free_name, give_back, join_checked, q, slices, stored
from journey.llm.components import connected_components
from journey.llm.wordhash import gram_hashes, mix, word_hashes

# --- fixed values: the contract's shingle size and threshold; the method's parameters
SHINGLE = 4
PERCENT = 85
#: tokens counted this often within CHUNK shingles of a task are candidates for the frequent end of the order
LOCAL_MIN, CHUNK, MAX_HEAVY = 2, 1_000_000, 100_000
#: words counted this often within CHUNK words of a task are candidates for the frequent words
WORD_MIN, MAX_WORDS = 2, 200_000
#: a frequent token's list is dealt to so many tasks in the first comparison
SALTS = 16
#: lists of so many classes are compared in full at once
SMALL = 8
#: longer lists with so many classes outside the largest component get more pivots before the exact step
BIG, PIVOTS, ROUNDS = 16, 4, 3
#: another round is worth its cost if one in so many compared pairs was a link
WORTH = 10
ANCHORS = 8
#: so many members of a list are compared with the whole list by one task where links are counted
PART = 512
#: bits of a parity bitmap: eight for a token, at most this many
MAX_BITS = 1 << 14
#: bytes of text that a task holds with their sets at once, one text at least
TEXT_BYTES = 2 << 20
SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)
# -------------------------------------------------------------------------------------------

_IS_WORD = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


def words_of(text: bytes | None) -> np.ndarray:
    """Hashes of the words of a text in UTF-8, A-Z lower-cased."""
    return word_hashes(text.lower(), _IS_WORD) if text else np.zeros(0, np.uint64)


def shingle_set(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's words."""
    return np.unique(gram_hashes(words, min(size, len(words)))) if len(words) else words


def class_key(tokens: np.ndarray) -> int:
    """64-bit name of a set: among 10^9 different sets a collision has a chance of about one in forty."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def prefix_by_hash(tokens: np.ndarray, which: int, percent: int) -> np.ndarray:
    """16-bit fingerprints of the prefix under the seeded hash order ``which``."""
    place = mix(tokens ^ np.uint64(SEEDS[which]))
    p = prefix_length(len(tokens), percent)
    kept = tokens[np.argpartition(place, p - 1)[:p]] if p < len(tokens) else tokens
    return np.unique((mix(kept) >> np.uint64(48)).astype(np.uint16).view(np.int16))


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys`` in the sorted ``table``, and which are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def parity_bits(tokens: np.ndarray) -> np.ndarray:
    """Which of the bitmap's places an odd number of tokens falls on, as 64-bit words.

    A token in one of two sets flips one bit, so bitmaps differ in at most as
    many bits as the sets differ in tokens, also after folding.
    """
    size = min(MAX_BITS, max(128, 1 << int(8 * len(tokens) - 1).bit_length()))
    places = (mix(tokens ^ np.uint64(SEEDS[3])) & np.uint64(size - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=size) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def thin_bits(whole: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A parity bitmap folded to about one bit for each of ``n`` tokens, and that folded once more where it can be.

    Sets of unlike texts still differ in far more of these bits than similar
    sets may, so they serve where every member of a list carries them along.
    """
    size = min(len(whole), max(1, (1 << max(n - 1, 1).bit_length()) // 64))
    while len(whole) > size:
        whole = whole[:len(whole) // 2] ^ whole[len(whole) // 2:]
    return whole, whole[:len(whole) // 2] ^ whole[len(whole) // 2:] if len(whole) > 1 else whole


class FirstOrder:
    """The order that deals out candidates.

    Heavy tokens are last, most frequent at the end.  Of the others, a shingle
    with a word outside the frequent ones is first; the rest follow by the
    binary logarithm of their rarest word's count.  A seeded hash decides
    among equals.
    """

    def __init__(self, heavy: np.ndarray, rank: np.ndarray, words: np.ndarray, level: np.ndarray):
        self.heavy, self.rank = heavy, rank  # sorted tokens, and their rank from rare to frequent
        self.words, self.level = words, level  # sorted frequent words, and 1 + log2 of their counts

    def prefix(self, words: np.ndarray, size: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The set, its prefix, which of the prefix are heavy, and how many tokens of the set are not."""
        size = min(size, len(words))
        tokens, first = np.unique(gram_hashes(words, size), return_index=True)
        at, frequent = _found(self.words, words)
        level = np.where(frequent, self.level[at] if len(self.level) else 0, 0)
        rarest = np.min([level[i:len(words) - size + 1 + i] for i in range(size)], axis=0)[first].astype(np.uint64)
        place = (mix(tokens ^ np.uint64(SEEDS[0])) >> np.uint64(8)) + (rarest << np.uint64(56))
        at, heavy = _found(self.heavy, tokens)
        if heavy.any():
            place[heavy] = self.rank[at[heavy]] + (np.uint64(1) << np.uint64(63))
        p = prefix_length(len(tokens), percent)
        first = np.argpartition(place, p - 1)[:p] if p < len(tokens) else np.arange(len(tokens))
        return tokens, tokens[first], heavy[first], int(len(tokens) - heavy.sum())


def _map_texts(df: DataFrame, start, ddl: str) -> DataFrame:
    """``mapInArrow`` with state per task: ``start()`` gives ``step(columns or None) -> rows``; None ends the task."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def batch_of(got):
        return pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in schema], schema=schema)

    def run(batches):
        step = start()
        for batch in batches:
            for piece in slices(batch, TEXT_BYTES):
                yield batch_of(step({n: piece.column(i).to_pylist() for i, n in enumerate(piece.schema.names)}))
        yield batch_of(step(None))
        give_back()

    return df.mapInArrow(run, ddl)


def _signed(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def scan(df: DataFrame, size: int) -> DataFrame:
    """Stored rows: (id, key, n) of every text, and (token, n) of tokens, and (word, n) of words, frequent within a task."""
    kind = df.schema["id"].dataType.simpleString()

    def start():
        seen: set[int] = set()
        kept: list[np.ndarray] = []
        spoken: list[np.ndarray] = []

        def often(arrays, least, column, got):
            values, n = np.unique(np.concatenate(arrays), return_counts=True)
            arrays.clear()
            many = n >= least
            fill = {"n": n[many].tolist(), column: _signed(values[many]).tolist()}
            for k in got:
                got[k].extend(fill.get(k) or [None] * int(many.sum()))

        def step(cols):
            got = {"id": [], "key": [], "n": [], "token": [], "word": []}
            for i, t in zip(cols["id"], cols["text_"], strict=True) if cols else ():
                words = words_of(t)
                tokens = shingle_set(words, size)
                key = class_key(tokens) if len(tokens) else None
                new = key is not None and key not in seen
                for k, v in (("id", i), ("key", key), ("n", len(tokens)), ("token", None), ("word", None)):
                    got[k].append(v)
                if new:
                    seen.add(key)
                    kept.append(tokens)
                    spoken.append(words)
            if kept and (cols is None or sum(map(len, spoken)) > CHUNK):
                often(kept, LOCAL_MIN, "token", got)
                often(spoken, WORD_MIN, "word", got)
            return got

        return step

    ddl = f"id {kind}, key long, n long, token long, word long"
    return stored(_map_texts(df, start, ddl), "join-scan")


def postings(df: DataFrame, size: int, percent: int, order) -> DataFrame:
    """(token, salt, rare, key, n) of the first order's prefix, once for each class and task."""
    def start():
        seen: set[int] = set()

        def step(cols):
            got = {"token": [], "salt": [], "rare": [], "key": [], "n": []}
            for t in cols["text_"] if cols else ():
                words = words_of(t)
                if not len(words):
                    continue
                tokens, prefix, heavy, rare = order.value.prefix(words, size, percent)
                key = class_key(tokens)
                if key in seen:
                    continue
                seen.add(key)
                got["token"].append(_signed(prefix))
                got["salt"].append(np.where(heavy, key % SALTS, -1))
                for k, v in (("key", key), ("n", len(tokens)), ("rare", rare)):
                    got[k].append(np.full(len(prefix), v, np.int64))
            return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in got.items()}

        return step

    return _map_texts(df.select("text_"), start, "token long, salt int, rare long, key long, n long")


LISTS = "token long, heavy boolean, key long, n long, rare long, other long, other_n long, other_rare long, long boolean"


def lists(posts: DataFrame, percent: int) -> DataFrame:
    """Stored candidates from each (token, salt) run of classes.

    Short runs: a row for each pair of sizes close enough.  Long runs, and all
    parts of heavy tokens: a row for each member with the run's first member
    (fewest rare tokens) as ``other``.  Runs stream by; a buffer holds ``SMALL``
    rows at most.
    """
    rows = posts.repartition("token", "salt").sortWithinPartitions("token", "salt", "rare", "key")
    schema = to_arrow_schema(StructType.fromDDL(LISTS))
    small = SMALL

    def run(batches):
        run_, first, count, head, last = None, None, 0, [], None
        out: list[tuple] = []

        def close():
            if run_ is None or count > small or run_[1] >= 0:
                return
            for i, (ra, ka, na) in enumerate(head):
                for rb, kb, nb in head[i + 1:]:
                    if 100 * min(na, nb) >= percent * max(na, nb):
                        out.append((run_[0], False, ka, na, ra, kb, nb, rb, False))

        for batch in batches:
            for piece in slices(batch):
                token, salt, rare, key, n = (piece.column(i).to_numpy() for i in range(5))
                # a row that differs in token from both neighbours is a run of its own; most are
                alone = np.ones(len(token), bool)
                alone[1:] &= token[1:] != token[:-1]
                alone[:-1] &= token[:-1] != token[1:]
                alone[[0, -1]] = False
                alone &= salt < 0
                for i in np.flatnonzero(~alone).tolist():
                    at = (int(token[i]), int(salt[i]))
                    row = (int(rare[i]), int(key[i]), int(n[i]))
                    if at != run_:
                        close()
                        run_, first, count, head, last = at, row, 0, [], None
                    if row[1] == last:
                        continue
                    last = row[1]
                    count += 1
                    if count <= small and at[1] < 0:
                        head.append(row)
                        continue
                    for r in (*head, row):
                        out.append((at[0], at[1] >= 0, r[1], r[2], r[0], first[1], first[2], first[0], True))
                    head = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        give_back()

    return stored(rows.mapInArrow(run, LISTS), "join-lists")


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _close(a: Column, b: Column, percent: int) -> Column:
    return (100 * F.least(a, b)) >= percent * F.greatest(a, b)


def _share(n: Column, percent: int) -> Column:
    """ceil(percent / 100 * n)"""
    return F.ceil(n * percent / F.lit(100))


def least_shared(a: Column, b: Column, percent: int) -> Column:
    """How many prefix tokens two similar sets of sizes ``a`` and ``b`` share at least, whatever the order.

    Similar sets share o >= t / (1 + t) * (a + b) tokens.  At most a - o of
    a's tokens are not shared, so its prefix of a - ceil(t a) + 1 holds at least
    o - ceil(t a) + 1 of the shared ones, and these are the first shared ones
    in the order; likewise for b.
    """
    overlap = F.ceil((a + b) * percent / F.lit(100 + percent))
    return F.greatest(F.lit(1), overlap - F.greatest(_share(a, percent), _share(b, percent)) + 1)


def passing(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share enough prefix tokens under the second and the third order as well; stored."""
    side = lambda s: sets.select(*[F.col(c).alias(f"{c}_{s}") for c in ("key", "n", "second", "third")])
    both = pairs.join(side("a"), F.col("a") == F.col("key_a")).join(side("b"), F.col("b") == F.col("key_b"))

    def met(order):
        lost = [F.col(f"n_{s}") - _share(F.col(f"n_{s}"), percent) + 1 - F.size(f"{order}_{s}") for s in "ab"]
        need = F.greatest(F.lit(1), least_shared(F.col("n_a"), F.col("n_b"), percent) - F.least(*lost))
        return F.size(F.array_intersect(f"{order}_a", f"{order}_b")) >= need

    return stored(both.where(met("second") & met("third")).select("a", "b"), "join-pairs")


def verified(pairs: DataFrame, sets: DataFrame, read: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; stored.

    Parity bitmaps of one or two bits a token go first; only the sets of pairs
    that they cannot tell apart are read (``read``: see ``_tokens``) and shuffled.
    """
    bitmap = lambda s: sets.select(*[F.col(c).alias(f"{c}_{s}") for c in ("key", "n", "bits", "half")])
    near = pairs.join(bitmap("l"), F.col("a") == F.col("key_l")).join(bitmap("r"), F.col("b") == F.col("key_r"))
    pairs = stored(near.where(_near_bits(percent)).select("a", "b").distinct(), "join-near")
    used = pairs.select(F.col("a").cast("string").alias("used")).union(pairs.select(F.col("b").cast("string")))
    used = stored(used.distinct(), "join-used")
    if used.isEmpty():
        return pairs
    sets = read(used)
    side = lambda s: sets.select(*[F.col(c).alias(f"{c}_{s}") for c in ("key", "n", "tokens")])
    both = pairs.join(side("a"), F.col("a") == F.col("key_a")).join(side("b"), F.col("b") == F.col("key_b"))
    same = F.size(F.array_intersect("tokens_a", "tokens_b"))
    enough = 100 * same >= percent * (F.col("n_a") + F.col("n_b") - same)
    return stored(both.where(enough).select("a", "b"), "join-links")


def _read_again(df: DataFrame, names: DataFrame, size: int, ddl: str, more) -> DataFrame:
    """(key, n, ..) of the texts whose id is among ``names``, once for each class and task; ``more(tokens)`` gives the other columns."""
    texts = df.withColumn("name", F.coalesce(F.col("id").cast("string"), F.lit("")))
    texts = join_checked(texts, names, "name", "left_semi").select("text_")
    columns = StructType.fromDDL(ddl).names

    def start():
        seen: set[int] = set()

        def step(cols):
            got = {k: [] for k in ("key", "n", *columns)}
            for t in cols["text_"] if cols else ():
                tokens = shingle_set(words_of(t), size)
                key = class_key(tokens) if len(tokens) else None
                if key is None or key in seen:
                    continue
                seen.add(key)
                for k, v in zip(got, (key, len(tokens), *more(tokens)), strict=True):
                    got[k].append(v)
            return got

        return step

    return _map_texts(texts, start, f"key long, n long, {ddl}")


def _one_row_a_class(sets: DataFrame) -> DataFrame:
    sets = stored(sets, "join-sets")
    # a class is there twice only if rows in several tasks repeat both its name's id and its text
    if sets.groupBy("key").count().where("count > 1").isEmpty():
        return sets
    return stored(sets.dropDuplicates(["key"]), "join-sets")


def _sets(df: DataFrame, names: DataFrame, size: int, percent: int) -> DataFrame:
    """Stored (key, n, second, third, bits, half) of the texts whose id is among ``names``, one row a class.

    ``second`` and ``third`` are the prefixes' fingerprints, ``bits`` and ``half`` the thin parity bitmaps.
    The tokens, many times larger, are left to ``_tokens``.
    """
    def more(tokens):
        return (prefix_by_hash(tokens, 1, percent), prefix_by_hash(tokens, 2, percent),
                *thin_bits(parity_bits(tokens), len(tokens)))

    return _one_row_a_class(_read_again(df, names, size, "second array<smallint>, third array<smallint>, "
                                                         "bits array<long>, half array<long>", more))


def _tokens(df: DataFrame, classes: DataFrame, used: DataFrame, size: int) -> DataFrame:
    """Stored (key, n, tokens) of the classes whose keys, as strings, are ``used``, one row a class."""
    wanted = join_checked(classes.withColumn("used", F.col("key").cast("string")), used, "used", "left_semi")
    names = stored(wanted.select("name").distinct(), "join-names")
    sets = _read_again(df, names, size, "tokens array<long>", lambda tokens: (_signed(tokens),))
    sets = join_checked(sets.withColumn("used", F.col("key").cast("string")), used, "used", "left_semi")
    return _one_row_a_class(sets.drop("used"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
                    percent: int = PERCENT, links: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    With ``links`` also ``n_links``: how many other rows are similar enough to the row.
    """
    spark = docs.sparkSession
    df = docs.select(q(doc_id).alias("id"), q(text).cast("string").cast("binary").alias("text_"))
    found = scan(df, size)
    rows = found.where("token is null and word is null").select("id", "key", "n")
    classes = stored(rows.where("key is not null").groupBy("key").agg(
        F.min("id").alias("low"), F.min(F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("name")), "join-classes")
    order = spark.sparkContext.broadcast(_first_order(found))
    rows_of = lists(postings(df, size, percent, order), percent)
    close = _close(F.col("n"), F.col("other_n"), percent)
    pairs = rows_of.where(close & (F.col("key") != F.col("other"))).select(*_pair(F.col("key"), F.col("other")))
    # the parts of a heavy token meet through their pivots
    pivots = rows_of.where("heavy").select("token", F.struct("other_rare", "other", "other_n").alias("p")).distinct()
    tops = pivots.groupBy("token").agg(F.min("p").alias("top"))
    across = pivots.join(tops, "token").where(_close(F.col("p.other_n"), F.col("top.other_n"), percent))
    across = across.where("p.other <> top.other").select(*_pair(F.col("p.other"), F.col("top.other")))
    pairs = stored(pairs.unionByName(across).distinct(), "join-candidates")
    members = rows_of.where("long").select("key")
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).union(members).distinct()
    names = stored(classes.join(wanted, "key", "left_semi").select("name").distinct(), "join-names")
    if names.isEmpty():
        comps = spark.createDataFrame([], "node long, comp long")
        linked = spark.createDataFrame([], "a long, b long")
    else:
        sets = _sets(df, names, size, percent)
        long_lists = rows_of.where("long").select("token", "key", "n").distinct()
        read = lambda used: _tokens(df, classes, used, size)
        linked = verified(passing(pairs, sets, percent), sets, read, percent)
        comps = _merge(long_lists, linked, sets, read, percent)
        if links:
            linked = linked.unionByName(_within(long_lists, sets, read, percent)).distinct()
    named = classes.join(comps.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "low", F.coalesce("comp", "key").alias("comp"))
    least = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    of_class = named.join(least, "comp").select("key", "component_id")
    counts = []
    if links:
        # links between classes, weighted by the classes' rows; equal sets are linked with each other
        of_class = of_class.join(_links_of(rows, linked), "key")
        counts = ["n_links"]
    full = rows.where("key is not null").join(of_class, "key").select("id", "n", "component_id", *counts)
    bare = rows.where("key is null").select("id", "n", F.col("id").alias("component_id"),
                                            *[F.lit(0).cast("long").alias(c) for c in counts])
    return full.unionByName(bare).select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id", *counts)


def _links_of(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """(key, n_links) of every class from the pairs (a, b) of linked classes."""
    sizes = rows.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    both = linked.select(F.col("a").alias("key"), F.col("b").alias("other")).union(linked.select("b", "a"))
    others = both.join(sizes.select(F.col("key").alias("other"), "size"), "other").groupBy("key").agg(
        F.sum("size").alias("others"))
    return sizes.join(others, "key", "left").select(
        "key", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"))


def _first_order(found: DataFrame) -> FirstOrder:
    """Ordering tables from the counts of all tasks, both cut to a fixed size.

    The cut is a count, found from a histogram of counts in eighths of a
    power of two, so only what is kept reaches the driver.
    """
    def most(column, limit):
        often = found.where(F.col(column).isNotNull()).groupBy(column).agg(F.sum("n").alias("n"))
        often = stored(often.withColumn("step", F.floor(8 * F.log2("n"))), f"join-{column}s")
        least, total = 1 << 30, 0
        for r in sorted(often.groupBy("step").count().collect(), reverse=True):
            total += r["count"]
            if total > limit:
                break
            least = r["step"]
        got = often.where(F.col("step") >= least).select(column, "n").toPandas()
        got = got.sort_values(["n", column], ascending=[False, True])
        values, counts = got[column].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(np.int64)
        order = np.argsort(values)
        return values[order], counts[order], order

    heavy, _, at = most("token", MAX_HEAVY)
    words, counts, _ = most("word", MAX_WORDS)
    return FirstOrder(heavy, np.arange(len(heavy), 0, -1).astype(np.uint64)[at], words,
                      1 + np.log2(np.maximum(counts, 1)).astype(np.int64))


def _merge(long_lists: DataFrame, links: DataFrame, sets: DataFrame, read: Callable[[DataFrame], DataFrame],
           percent: int) -> DataFrame:
    """Components (node, comp) of ``links`` and of all further links between members of a long list."""
    last, turn = False, 0
    while True:
        comps = connected_components(links)
        now = long_lists.join(comps, long_lists["key"] == comps["node"], "left").select(
            "token", "key", "n", F.coalesce("comp", "key").alias("comp"))
        now = stored(now, "join-now")
        sizes = now.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("m"))
        main = sizes.groupBy("token").agg(F.max(F.struct("m", "comp")).alias("main"), F.sum("m").alias("m"),
                                          F.count(F.lit(1)).alias("parts"))
        # lists with several components; their members outside the largest one
        open_ = stored(main.where("parts > 1").select(
            "token", "m", F.col("main.comp").alias("main"), (F.col("m") - F.col("main.m")).alias("outside")), "join-open")
        if open_.isEmpty():
            return comps
        live = now.join(open_, "token")
        if last or turn == ROUNDS or open_.where(F.col("outside") >= BIG).isEmpty():
            break
        # more pivots from the largest component of the long lists
        long = live.where(F.col("outside") >= BIG)
        turn += 1
        picks = [F.min(F.struct(F.xxhash64("key", F.lit(turn * PIVOTS + i)).alias("h"), "key", "n")).alias(f"p{i}")
                 for i in range(PIVOTS)]
        pivots = long.where("comp = main").groupBy("token").agg(*picks)
        probe = long.where("comp <> main").join(pivots, "token").select(
            "key", "n", F.explode(F.array(*[f"p{i}" for i in range(PIVOTS)])).alias("p"))
        probe = probe.where(_close(F.col("n"), F.col("p.n"), percent)).select(*_pair(F.col("key"), F.col("p.key")))
        probe = passing(probe.distinct(), sets, percent)
        new = verified(probe, sets, read, percent)
        links = stored(links.unionByName(new), "join-links")
        last = new.count() * WORTH < probe.count()  # further pivots would mostly miss
    # exact step
    live = _anchored(live, sets)
    carried = ("key", "n", "comp", "main", "anchors", "bits", "half")
    left = live.where("comp <> main").select("token", *[F.col(c).alias(f"{c}_l") for c in carried])
    right = live.select(F.col("token").alias("token_r"), *[F.col(c).alias(f"{c}_r") for c in carried])
    once = (F.col("comp_r") == F.col("main_r")) | (F.col("key_l") < F.col("key_r"))
    wanted = (F.col("comp_l") != F.col("comp_r")) & _close(F.col("n_l"), F.col("n_r"), percent) & once & (
        _in_anchor()) & _near_bits(percent)
    rest = left.join(right, (F.col("token") == F.col("token_r")) & wanted)
    rest = passing(rest.select(*_pair(F.col("key_l"), F.col("key_r"))).distinct(), sets, percent)
    if rest.isEmpty():
        return comps
    return connected_components(links.unionByName(verified(rest, sets, read, percent)))


def _anchored(live: DataFrame, sets: DataFrame) -> DataFrame:
    """``live`` (token, m, key, ..) with each class's longest lists and bitmaps."""
    anchors = live.groupBy("key").agg(F.slice(F.transform(F.sort_array(F.collect_set(F.struct("m", "token")), False),
                                                          lambda x: x["token"]), 1, ANCHORS).alias("anchors"))
    return live.join(anchors.join(sets.select("key", "bits", "half"), "key"), "key")


def _in_anchor() -> Column:
    """A pair that shares several lists is taken from one of the longest that both sides are in."""
    common = F.array_intersect("anchors_l", "anchors_r")
    return (F.size(common) == 0) | (F.array_max(common) == F.col("token"))


def _within(long_lists: DataFrame, sets: DataFrame, read: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """The linked pairs (a, b) of all long lists, whatever component they are in; each list is dealt out by its length."""
    count = long_lists.groupBy("token").agg(F.count(F.lit(1)).alias("m"))
    live = stored(_anchored(long_lists.join(count, "token"), sets), "join-within")
    parts = F.ceil(F.col("m") / PART).cast("int")
    carried = ("key", "n", "anchors", "bits", "half")
    left = live.select("token", F.pmod(F.xxhash64("key"), parts).cast("int").alias("part"),
                       *[F.col(c).alias(f"{c}_l") for c in carried])
    right = live.select(F.col("token").alias("token_r"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part_r"),
                        *[F.col(c).alias(f"{c}_r") for c in carried])
    wanted = (F.col("key_l") < F.col("key_r")) & _close(F.col("n_l"), F.col("n_r"), percent) & _in_anchor() & _near_bits(percent)
    near = left.join(right, (F.col("token") == F.col("token_r")) & (F.col("part") == F.col("part_r")) & wanted)
    return verified(passing(near.select(*_pair(F.col("key_l"), F.col("key_r"))).distinct(), sets, percent), sets, read, percent)


def _near_bits(percent: int) -> Column:
    """Whether the bitmaps of sides ``l`` and ``r`` differ in no more bits than similar sets differ in tokens."""
    def apart(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)

    n = F.col("n_l") + F.col("n_r")
    left, right = F.size("bits_l"), F.size("bits_r")
    differ = F.when(left == right, apart("bits_l", "bits_r")).when(left > right, apart("half_l", "bits_r")).otherwise(
        apart("bits_l", "half_r"))
    return differ <= n - 2 * F.ceil(n * percent / F.lit(100 + percent))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one whose id names it; rows with a null id stay.

    Rows that repeat a kept id become one row.  Ids that go, and repeated ids,
    are found on slim rows; texts move only if those ids are too many to
    broadcast.
    """
    ids = stored(near_duplicates(docs, doc_id, text).where(q(doc_id).isNotNull()), "join-result")
    name = free_name(docs.columns, "name")
    key = q(doc_id).cast("string").alias(name)
    gone = stored(ids.where(q(doc_id) != F.col("component_id")).select(key).distinct(), "join-gone")
    twice = stored(ids.where(q(doc_id) == F.col("component_id")).groupBy(key).count().where("count > 1").select(name),
                   "join-twice")
    named = docs.withColumn(name, key)
    kept = join_checked(named, gone, name, "left_anti")
    single = join_checked(kept, twice, name, "left_anti")
    repeated = join_checked(kept, twice, name, "left_semi").dropDuplicates([name])
    return single.unionByName(repeated).select(*[q(c) for c in docs.columns])
