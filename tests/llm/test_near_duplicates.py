"""The n-gram Jaccard join, its components, and the pipeline against brute force."""

from __future__ import annotations

import glob
import random
import tempfile
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from journey.llm import common, ngram_join, secret_scan
from journey.llm.components import connected_components
from journey.llm.wordhash import _PIECE, word_hashes
from tests.llm import brute
from tests.llm.conftest import EDGE, documents, prose


def family(seed, n, length, most):
    """Copies of one text with up to ``most`` words changed."""
    rng = random.Random(seed)
    base = prose(seed, length)
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(length)] = f"w{seed}x{rng.randrange(10 ** 9)}"
        out.append((seed * 1000 + i, " ".join(words)))
    return out


def corpus():
    shared = " ".join(prose(99, 12))
    docs = list(EDGE) + family(1, 60, 120, 6) + family(2, 20, 60, 3) + family(3, 10, 2000, 40)
    docs += [(9000 + i, shared + " " + " ".join(prose(500 + i, 3 + i % 20))) for i in range(60)]
    docs += [(9500 + i, " ".join(prose(700 + i % 7, 9)).upper() if i % 2 else " ".join(prose(700 + i % 7, 9))) for i in range(30)]
    return docs


@pytest.mark.parametrize("big", [16, 2])
def test_components_match_all_pairs(spark, big, monkeypatch):
    monkeypatch.setattr(ngram_join, "BIG", big)
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    monkeypatch.setattr(ngram_join, "SMALL", big // 2)
    docs = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           ngram_join.near_duplicates(documents(spark, docs)).collect()}
    assert got == brute.components(docs)


@pytest.mark.parametrize(("heavy", "part"), [(100_000, 512), (3, 512), (100_000, 7)])
def test_links_match_all_pairs(spark, heavy, part, monkeypatch):
    monkeypatch.setattr(ngram_join, "MAX_HEAVY", heavy)
    monkeypatch.setattr(ngram_join, "PART", part)
    docs = corpus() + [(None, "A b c d e f"), *[(7000 + i, t) for i, (_, t) in enumerate(family(1, 9, 120, 6))]]
    sets = [brute.shingles(t) for _, t in docs]
    want = [sum(1 for j, b in enumerate(sets) if i != j and a and b and 100 * len(a & b) >= 85 * len(a | b))
            for i, a in enumerate(sets)]
    out = ngram_join.near_duplicates(documents(spark, docs), links=True)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    got = sorted(((r["doc_id"], r["n_links"]) for r in out.collect()), key=repr)
    assert got == sorted(((i, n) for (i, _), n in zip(docs, want, strict=True)), key=repr)
    assert max(want) > 20
    assert ngram_join.near_duplicates(documents(spark, []).limit(0), links=True).count() == 0


def test_orders_do_not_change_the_links(spark, monkeypatch):
    docs = corpus()
    monkeypatch.setattr(ngram_join, "MAX_HEAVY", 3)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicates(documents(spark, docs)).collect()}
    assert got == {d: c for d, (_, c) in brute.components(docs).items()}


def test_sets_are_stored_for_compared_classes_only(spark, monkeypatch):
    made, plain = [], ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, name: made.append((name, plain(df, name))) or made[-1][1])
    # a line with another last word each stands in one long list, but is less than 85 % alike
    shared = " ".join(prose(99, 12))
    docs = [(i, f"{shared} u{i}") for i in range(40)]
    docs += [(100 + i, t) for i, (_, t) in enumerate(family(5, 4, 200, 3))]
    got = ngram_join.near_duplicates(documents(spark, docs))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {d: c for d, (_, c) in brute.components(docs).items()}
    held = sum(t.count() for _, t in made if "tokens" in t.columns)
    used = sum(t.count() for name, t in made if name == "join-used")
    sketched = max(t.count() for _, t in made if "second" in t.columns)
    assert 2 <= held <= used < 40 <= sketched


def test_shuffle_files_of_a_stored_table_go_when_it_is_written(spark):
    def there():
        return set(glob.glob(f"{spark.conf.get('spark.local.dir', tempfile.gettempdir())}/blockmgr-*/*/shuffle_*.data"))

    setting, before = spark.conf.get(common.SHUFFLE_CLEANUP), there()
    dealt = spark.range(1000).repartition(3, "id")
    assert dealt.count() == 1000 and there() - before  # the place looked at is the right one
    before = there()
    back = common.stored(dealt, "test")
    end = time.monotonic() + 20
    while there() - before and time.monotonic() < end:
        time.sleep(0.1)
    assert not there() - before
    assert back.count() == 1000 and spark.conf.get(common.SHUFFLE_CLEANUP) == setting


def test_null_ids_and_empty(spark):
    got = ngram_join.near_duplicates(documents(spark, [(None, "a b c d e"), (4, "A b c d e"), (None, "")])).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=repr) == [(4, 4), (None, 4), (None, None)]
    assert ngram_join.near_duplicates(documents(spark, []).limit(0)).count() == 0


def test_connected_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(25)]
    label = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["comp"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: c for x, c in label.items() if x in got}
    assert set(label) - set(got) <= {a for a, b in edges if a == b}


def test_word_hashes_depend_on_the_word_alone():
    is_word = np.array([b != 32 for b in range(256)])
    one = word_hashes(b"alpha beta", is_word)
    far = word_hashes(b"beta " * 3 + b"x" * _PIECE + b" " + b"q " * _PIECE + b"alpha", is_word)
    assert far[0] == far[1] == one[1] and far[-1] == one[0] and len(far) == 3 + 1 + _PIECE + 1


def test_pipeline_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    fails = {d: brute.rules(t)[-1] for d, t, _ in docs}
    hosts: dict[str, list[bool]] = {}
    for d, _, s in docs:
        hosts.setdefault(s, []).append(fails[d])
    bad = brute.bad_hosts(hosts)
    kept = [(d, t) for d, t, s in docs if not fails[d] and s not in bad]
    comp = brute.components(kept)
    kept = [(d, t) for d, t in kept if comp[d][1] == d]
    wins = brute.contam_windows(items)
    kept = [(d, t) for d, t in kept if not brute.contam(t, wins)[-1]]
    tok = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = []
    for d, t in kept:
        spans = secret_scan.label(secret_scan.find_spans(t))
        ids = [*tok.encode(secret_scan.redact(t, spans) if spans else t, add_special_tokens=False).ids, 2]
        want += [(d, s, len(ids[s:s + 4096]), zlib.crc32(np.array(ids[s:s + 4096], "<u4").tobytes()))
                 for s in range(0, len(ids), 4096)]
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)


def test_one_of_each(spark):
    docs = documents(spark, [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, ""), (4, ""), (5, None), (6, "z"), (6, "z"), (None, "z")])
    got = ngram_join.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=repr) == [1, 3, 4, 5, 6, None]


def test_thin_bitmaps_differ_in_no_more_bits_than_the_sets_in_tokens():
    rng = np.random.default_rng(4)
    for n in (1, 2, 40, 64, 65, 300, 2100, 9000):
        for other in (n, int(n * 0.9), int(n * 0.86) + 1):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[:other], rng.integers(0, 1 << 63, n // 20, dtype=np.uint64)]))
            (x, x_half), (y, y_half) = (ngram_join.thin_bits(ngram_join.parity_bits(t), len(t)) for t in (a, b))
            if len(x) != len(y):
                x, y = (x_half, y) if len(x) > len(y) else (x, y_half)
            assert len(x) == len(y) and len(x) <= max(1, 2 * n // 64 + 1)
            assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= len(np.setxor1d(a, b))
