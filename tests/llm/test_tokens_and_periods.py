"""Token counts, cross-tokenizer alignment and periodic runs against the libraries and plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from journey.llm import alignment, periodic, queries, token_counts
from journey.llm.encoders import Encoder
from tests.llm.conftest import EDGE, documents, prose

BITS = ["a", "bc", " ", "  ", "\n", "\n ", "\t", "'s", "'re", "1", "23", ".", "<|endoftext|>", "</s>", "<s>", "<unk>", "\xa0",
        "　", "▁", "é", "ß", "漢字", "。", "\x1c", "\x85", "İ", "Σ", "é", "\U0001f600", "​", "<0x0A>", "_", "don't", " the",
        "\r\n", "\x0b", "\x00"]
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def noise(seed, n, size=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, size))) for _ in range(n)]


#: long texts with white space, with class changes only, and without any safe place
LONG = [noise(1, 1, 200_000)[0], "a1" * 150_000, "漢字。" * 60_000, "x" * 200_000, " " * 150_000, "a " * 140_000]


def library_ids(name, texts, plain=False):
    if name.endswith(".model"):
        return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name)).encode(texts)
    made = Tokenizer.from_file(public_tokenizers.path(name))
    made.encode_special_tokens = plain
    return [e.ids for e in made.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", [A, B, "word_bpe_49k.json"])
def test_pieces_have_the_ids_of_whole_texts(name):
    texts = noise(2, 3000) + [t or "" for _, t in EDGE] + LONG
    encoder = Encoder(public_tokenizers.path(name))
    want = library_ids(name, texts)
    assert encoder.cuts
    assert encoder.count(texts) == [len(i) for i in want]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.ids(texts)] == want


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr("journey.llm.encoders.REMEMBER", 40)
    monkeypatch.setattr("journey.llm.encoders.LONG", 200)
    texts = noise(3, 400) + [" ".join(prose(4, 3000))]
    encoder = Encoder(public_tokenizers.path(A))
    assert encoder.count(texts) == [len(i) for i in library_ids(A, texts)]
    assert len(encoder.counts) <= 200


def test_batches_are_balanced_by_bytes():
    encoder = Encoder(public_tokenizers.path(A))
    sizes = [sum(map(len, b)) for b in encoder.batches(["x" * 100] * 10_000 + ["y" * 900_000] + ["z"] * 10)]
    assert sizes[:3] == [262_100, 262_100, 262_100] and max(sizes[:-1]) == 900_000
    assert list(token_counts.byte_ranges([5, 5, 20, 0, 3], 10)) == [(0, 2), (2, 3), (3, 5)]


def test_token_counts(spark):
    rows = EDGE + [(None, "no id")] + list(enumerate(noise(5, 300) + LONG[:2], 100))
    got = token_counts.count_tokens(documents(spark, rows), public_tokenizers.path(A), carry=("doc_id", "n_words")).collect()
    texts = [t or "" for _, t in rows]
    want = [(i, "x", len(t.encode()), len(x), len(x) > 1024)
            for (i, _), t, x in zip(rows, texts, library_ids(A, texts), strict=True)]
    assert Counter(map(tuple, got)) == Counter(want)


def test_token_counts_of_no_rows_and_clashing_names(spark):
    docs = documents(spark, EDGE)
    assert token_counts.count_tokens(docs.limit(0), public_tokenizers.path(B)).collect() == []
    with pytest.raises(ValueError, match="n_tokens"):
        token_counts.count_tokens(docs.withColumnRenamed("key", "n_tokens"), public_tokenizers.path(A), carry=("n_tokens",))


def plain_alignment(texts):
    """(n_a, n_b, groups, links) of every text by merging both sides' ends."""
    tables = [alignment.byte_table(Encoder.of(public_tokenizers.path(n), plain=True)) for n in (A, B)]
    out = []
    for t, a, b in zip(texts, library_ids(A, [" " + (t or "") for t in texts], plain=True),
                       library_ids(B, [t or "" for t in texts]), strict=True):
        whole = b" " + (t or "").encode()
        if not t or any(b"".join(k[i] for i in ids) != whole for k, ids in zip(tables, (a, b), strict=True)):
            out.append((0, 0, [], []))
            continue
        owner = [[i for i, x in enumerate(ids) for _ in k[x]] for k, ids in zip(tables, (a, b), strict=True)]
        links = sorted(set(zip(*owner, strict=True)))
        ends = [{sum(len(k[x]) for x in ids[:n + 1]) for n in range(len(ids))} if len(ids) < 200 else
                set(np.cumsum([len(k[x]) for x in ids]).tolist()) for k, ids in zip(tables, (a, b), strict=True)]
        common, groups, at = sorted(ends[0] & ends[1]), [], 0
        for e in common:
            mine = [sorted(set(o[at:e])) for o in owner]
            groups.append("|".join(",".join(str(ids[i]) for i in m) for m, ids in zip(mine, (a, b), strict=True)))
            at = e
        out.append((len(a), len(b), groups, [(a[i], b[j]) for i, j in links]))
    return out


@pytest.mark.parametrize("chunk_links", [alignment.CHUNK_LINKS, 300])
def test_alignment_counts_links_of_the_whole_corpus(spark, monkeypatch, chunk_links):
    monkeypatch.setattr(alignment.align_rows, "__defaults__", (*alignment.align_rows.__defaults__[:-1], chunk_links))
    rows = EDGE + [(None, "no id"), (None, "no id")] + list(enumerate(noise(6, 400) + [" ".join(prose(7, 2000))] * 3, 100))
    made = alignment.align(documents(spark, rows), public_tokenizers.path(A), public_tokenizers.path(B), groups=True)
    plain = plain_alignment([t for _, t in rows])
    n = Counter(p for *_, links in plain for p in links)
    best = {}
    for (_, b), k in n.items():
        best[b] = max(best.get(b, 0), k)
    want = [(i, a, b, len(g), len(x), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "", ";".join(g),
             sum(n[p] == best[p[1]] for p in x), sum(n[p] for p in x)) for (i, _), (a, b, g, x) in zip(rows, plain, strict=True)]
    assert Counter(map(tuple, made.collect())) == Counter(want)


def aligner():
    return alignment.Aligner(public_tokenizers.path(A), public_tokenizers.path(B))


@pytest.mark.parametrize(("remember", "chars"), [(400_000, 48), (40, 48), (40, 3)])
def test_alignment_by_pieces_is_that_of_whole_texts(monkeypatch, remember, chars):
    monkeypatch.setattr("journey.llm.encoders.REMEMBER", remember)
    monkeypatch.setattr("journey.llm.encoders.REMEMBER_CHARS", chars)
    texts = noise(8, 600) + ["a  b ", " a", "a\n b", "a\xa0 b", "a b\n", "   ", "\n", "a ▁ b", "a ▁", "x" * 100 + " y\n" + "z" * 60]
    texts += [t or "" for _, t in EDGE] + [" ".join(prose(9, 500))] * 2
    plain, made = plain_alignment(texts), aligner()
    assert len({len(g) > 0 for *_, g, _ in plain}) == 2
    for first in range(0, len(texts), 100):
        want = plain[first:first + 100]
        n_a, n_b, n_groups, n_links, said, pairs = made.align(texts[first:first + 100])
        assert list(zip(n_a, n_b, n_groups, n_links, strict=True)) == [(a, b, len(g), len(x)) for a, b, g, x in want]
        assert [s.decode() for s in said] == [";".join(g) for _, _, g, _ in want]
        second = len(made.sizes[1])
        assert Counter(pairs.tolist()) == Counter(a * second + b for *_, links in want for a, b in links)
        assert len(made.place) == len(made.groups) == made.numbers.shape[1] <= max(remember, 6_000)


def test_a_word_that_comes_again_is_tokenized_and_aligned_once(monkeypatch):
    halved, cut = [], alignment.cut_groups
    monkeypatch.setattr(alignment, "cut_groups", lambda a, b, bounds: halved.append(len(a)) or cut(a, b, bounds))
    made, text = aligner(), " ".join(prose(10, 40) * 50)
    numbers = [made.align([text, text])[:4] for _ in range(3)]
    assert len({tuple(map(tuple, n)) for n in numbers}) == 1
    assert 0 < sum(halved) < numbers[0][0][0] / 10


def test_a_text_with_a_piece_that_is_not_given_back_has_no_tokens():
    made = aligner()
    ids = made.b.library.encode("broken")
    made.bytes_of[1][ids] = [x.upper() for x in made.bytes_of[1][ids]]
    numbers = np.array(made.align(["all is well", "one is broken here", "all"])[:4])
    assert (numbers[:, 1] == 0).all() and (numbers[:, [0, 2]] > 0).all()


def test_alignment_of_no_rows(spark):
    none = documents(spark, EDGE).limit(0)
    assert alignment.align(none, public_tokenizers.path(A), public_tokenizers.path(B)).collect() == []


def test_cutless_intervals_are_leaves():
    ends_a = np.array([3, 6, 9, 10, 12, 15, 18, 20])
    ends_b = np.array([1, 2, 4, 5, 7, 8, 10, 11, 13, 14, 16, 17, 19, 20])
    assert alignment.cut_groups(ends_a, ends_b, np.array([8])).tolist() == [3, 7]
    assert alignment.cut_groups(ends_a, ends_a, np.array([0, 4, 4, 8])).tolist() == list(range(8))


def plain_runs(words, at_least):
    x, out = np.array([hash(w) for w in words], np.int64), {}
    for p in range(1, len(x) // 2 + 1):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (x[p:] == x[:-p]).astype(np.int8), [0]])))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if e - s >= p and e + p - s >= at_least:
                out.setdefault((s, e + p), p)
    return sorted((s, e - s, p) for (s, e), p in out.items())


def found_runs(ids, at_least):
    return sorted(zip(*[x.tolist() for x in periodic.find_runs(np.array(ids, np.int64), at_least)], strict=True))


def test_runs_of_all_short_binary_words():
    for n in range(12):
        for w in itertools.product((0, 1), repeat=n):
            assert found_runs(w, 2) == plain_runs(w, 2), w


def test_runs_of_structured_words():
    rng = random.Random(8)
    for _ in range(1500):
        w = []
        for _ in range(rng.randint(1, 5)):
            unit = [rng.randrange(rng.choice((1, 2, 3))) for _ in range(rng.randint(1, 14))]
            w += (unit * rng.randint(1, 6))[:rng.randint(1, 90)]
        assert found_runs(w, 12) == plain_runs(w, 12), w
    for m, k in itertools.product(range(1, 25), (2, 3)):  # one factor period with many periods around each break
        w = ([0, 1] * m + [0]) * k + [0, 1] * (m // 2)
        assert found_runs(w, 2) == plain_runs(w, 2), w


def test_planted_runs_in_documents(spark):
    rows = EDGE + [(None, "a b " * 20)] + [(i, " ".join(prose(i, 40 + i % 90, 3 + i % 300))) for i in range(400, 800)]
    rows.append((14, "x y z " * 5000))  # the checksum of 14 makes it periodic as well
    got = {}
    for r in queries_op11(spark, rows):
        got.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    for i, t in rows:
        words = (t or "").encode().split()
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        runs = plain_runs(words, 12)
        gone = {j for s, length, p in runs for j in range(s + p, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want = (len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
                hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
                hashlib.sha256(b" ".join(w for j, w in enumerate(words) if j not in gone)).hexdigest())
        assert want in got[i], i


def queries_op11(spark, rows):
    path = f"{queries.shared_dir(spark, 'op11-test')}"
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    return queries.op11_periodic_runs(spark, path).collect()


def test_runs_operator_returns_spans_and_texts(spark):
    docs = documents(spark, [(1, "go " + "a b c " * 6 + "end"), (2, None)])
    got = {r["doc_id"]: r for r in periodic.runs(docs, carry=("doc_id", "n_chars")).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(1, 18, 3)]
    assert got[1]["collapsed"] == "go a b c end" and got[1]["n_words"] == 20
    assert (got[2]["runs"], got[2]["collapsed"], got[2]["n_words"]) == ([], "", 0)
    assert periodic.runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError, match="runs"):
        periodic.runs(docs.withColumnRenamed("key", "Runs"), carry=("Runs",))
