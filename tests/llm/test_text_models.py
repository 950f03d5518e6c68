"""Chat formatting, packing, quality rules and the classifiers."""

from __future__ import annotations

import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from journey.llm import chat, packing, quality_model, quality_rules, toxicity
from tests.llm import brute
from tests.llm.conftest import EDGE, documents, prose

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"
TURNS = [(1, 0, "user", "<|im_start|>x<\\|y"), (1, 1, "assistant", "<|im_end|>\n"), (1, 1, "assistant", "<|im_end|>\n"),
         (2, None, None, None), (2, 3, "assistant", None), (2, 2, "ro\nle\\n<|", "text"), (None, 0, "assistant", "né"),
         (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"),
         *[(7, i, ("user", "assistant")[i % 2], f"turn {i} text") for i in range(75)]]
TURN_DDL = "conv_id long, turn long, role string, text string"


@given(st.text(alphabet="<|\\\nab"))
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    assert chat.read_back(chat.chatml([{"role": text, "text": text}])) == [(text, text)]


def test_chat_digests(spark):
    turns = spark.createDataFrame(TURNS, TURN_DDL).withColumnRenamed("turn", "turn")
    got = {r["conv"]: tuple(r)[1:5] for r in chat.digest(chat.format_turns(turns)).collect()}
    assert got == brute.chat(TURNS)
    sizes = {r["conv"]: r["formatted_chars"] for r in chat.digest(chat.format_turns(turns)).collect()}
    rows = sorted((r for r in TURNS if r[0] == 1), key=lambda r: r[1:])
    assert sizes[1] == len(chat.chatml([{"role": r, "text": t} for _, _, r, t in rows]))
    assert chat.digest(chat.format_turns(turns.limit(0))).count() == 0


def test_chat_finds_rewritten_history_and_spans():
    def strips_thoughts(messages):
        # an old answer loses its thought as soon as another turn follows
        out = []
        for i, m in enumerate(messages):
            text = m["text"] if i == len(messages) - 1 else m["text"].split("|")[-1]
            out.append(f"[{m['role']}]{text};")
        return "".join(out)

    turns = [{"role": "user", "text": "a"}, {"role": "assistant", "text": "think|b"}, {"role": "user", "text": "c"}]
    got = chat.render_block(strips_thoughts, [], turns)
    assert [g["rewrites"] for g in got] == [False, False, True]
    assert [g["piece"][g["text_start"]:g["text_end"]] for g in got[:2]] == ["a", "think|b"]
    plain = chat.render_block(chat.chatml, turns[:1], turns[1:])
    assert [g["rewrites"] for g in plain] == [False, False]
    assert plain[0]["piece"] == "<|im_start|>assistant\nthink|b<|im_end|>\n"


def rewriting(messages):
    """Numbers turns, repeats the first text, has a default system message, drops the tenth text before the last."""
    head = "" if messages and messages[0]["role"] == "system" else "[system]default;"
    out = [f"[{i}/{messages[0]['text']}/{m['role']}]{m['text'] if i != len(messages) - 10 else '-'};" for i, m in enumerate(messages)]
    return head + "".join(out)


def test_chat_templates_see_the_whole_history(spark):
    rows = [(c, i, ("user", "assistant")[i % 2], f"turn {c} {i} words") for c in (1, 2) for i in range(41)]
    turns = spark.createDataFrame(rows, TURN_DDL)
    cols = ("piece", "text_start", "text_end", "rewrites")
    for c in (1, 2):
        got = chat.format_turns(turns, render=rewriting).where(f"conv = {c}").orderBy("pos").collect()
        messages = [{"role": r, "text": t} for k, _, r, t in rows if k == c]
        assert [{k: r[k] for k in cols} for r in got] == chat.render_block(rewriting, [], messages)
        assert [r["rewrites"] for r in got] == [i >= 9 for i in range(41)]
        assert got[40]["piece"].endswith(rewriting(messages)[-40:])
    whole, blocks = (sorted(map(tuple, chat.format_turns(turns, looks_back=n).collect())) for n in (None, 0))
    assert whole == blocks


@pytest.mark.parametrize("back", [1, 3, 20])
def test_chat_blocks_hold_the_declared_history(spark, back):
    def window(messages):
        return "".join(f"{'-' if i < len(messages) - back else m['text']};" for i, m in enumerate(messages[-back - 1:], max(
            0, len(messages) - back - 1)))

    rows = [(1, i, "user", f"{i} text") for i in range(60)]
    turns = spark.createDataFrame(rows, TURN_DDL)
    want, got = (sorted(map(tuple, chat.format_turns(turns, render=window, looks_back=n).collect())) for n in (None, back))
    assert got == want


def test_packing_round_trip(spark):
    texts = EDGE + [(50 + i, " ".join(prose(i, 37 * i % 900))) for i in range(120)] + [(300, "<|endoftext|> Σ'S I'm ²³")]
    tok = Tokenizer.from_file(TOKENIZER)
    ids = [(i, [*tok.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in texts]
    want = sorted((i, s, len(d[s:s + 4096]), zlib.crc32(np.array(d[s:s + 4096], "<u4").tobytes()), len(d))
                  for i, d in ids for s in range(0, len(d), 4096))
    got = packing.pack_documents(documents(spark, texts), TOKENIZER).toPandas()
    assert sorted(map(tuple, got[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].to_numpy().tolist())) == want
    at = got.sort_values(["sequence_id", "offset"])
    assert (at.groupby("sequence_id")["length"].cumsum() - at["length"] == at["offset"]).all()
    fill = got.groupby("sequence_id")["length"].sum()
    assert fill.max() <= 4096 and fill.sum() > 0.9 * 4096 * (len(fill) - 1)
    assert packing.pack_documents(documents(spark, []).limit(0), TOKENIZER).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 2000), max_size=40))
def test_pack_histogram_places_every_piece(counts):
    placed: dict[int, int] = {}
    for n, pattern in packing.pack_histogram(counts, 64):
        assert sum(length * times for length, times in pattern) <= 64
        for length, times in pattern:
            placed[length] = placed.get(length, 0) + n * times
    assert placed == counts


@given(st.dictionaries(st.integers(1, 256), st.integers(1, 10**12), max_size=256))
def test_patterns_keep_their_bound_however_many_pieces_there_are(counts):
    patterns = packing.pack_histogram(counts, 256)
    assert len(patterns) <= 3 * len(counts)
    slots = packing.slots_of(patterns)
    assert sum(map(len, slots.values())) <= 3 * len(counts) * 2 * (2 * 256) ** 0.5


@pytest.mark.parametrize("count", [lambda n: 10**9, lambda n: 10**9 // n, lambda n: 10 ** int(9 * (1 - n / 4096)) + n])
def test_patterns_of_every_length_stay_small(count):
    slots = packing.slots_of(packing.pack_histogram({n: count(n) for n in range(1, 4097)}))
    assert sum(s.nbytes for s in slots.values()) < 71 << 20


def test_other_tokenizer_files_are_encoded_as_a_whole():
    e = packing.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not e.by_word
    assert len(e.encode("two words")) == 4 * len(e.tokenizer.encode("two words", add_special_tokens=False).ids)


def test_rules(spark):
    line = " ".join(prose(4, 30, 20))
    texts = EDGE + [(50, f"{line}\n{line}\n \n \n#$ |x|\n{line}"), (51, " ".join(prose(9, 300, 12))), (52, "a a a a"),
                    (53, "\x0b".join(prose(2, 80))), (54, " ".join(prose(2, 80)))]
    docs = documents(spark, texts)
    judged, names = quality_rules.apply_host_rules(docs)
    cols = [names[c] for c in quality_rules.METRICS]
    got = sorted(((r["doc_id"], *(r[c] for c in cols)) for r in judged.collect()), key=repr)
    assert got == sorted(((i, *brute.rules(t)) for i, t in texts), key=repr)
    assert names["n_words"] != "n_words" and judged.columns[:len(docs.columns)] == docs.columns
    assert quality_rules.keep_documents(docs).columns == docs.columns
    assert quality_rules.keep_documents(docs.limit(0)).count() == 0


def test_a_bad_host_takes_its_documents_along(spark):
    good, bad = " ".join(prose(1, 200)), "short"
    rows = [(i, bad if i % 50 else good, f"bad{i % 2}" if i < 400 else "ok") for i in range(400)]
    rows += [(i, good, f"ok{i % 7}") for i in range(400, 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in quality_rules.keep_documents(df).collect()}
    assert kept == set(range(400, 600))
    rates = {r["host"]: r for r in quality_rules.host_rates(
        df.selectExpr("source", "text = 'short' AS f"), "source", "f").collect()}
    assert 0 < rates["ok1"]["host_rate"] < 0.2 and rates["bad0"]["host_rate"] < 0.96


def test_a_host_is_rejected_only_when_surely_more_bad_than_good(spark):
    sizes = {"few": (3, 3), "unsure": (30, 18), "sure": (2000, 1200), "worse": (2000, 800), "alone": (1, 1)}
    sizes |= {f"ok{i}": (200, 20) for i in range(20)}
    good, bad = " ".join(prose(1, 200)), "short"
    rows = [(bad if i < fails else good, host) for host, (n, fails) in sizes.items() for i in range(n)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate([*rows, (good, None)])], "doc_id long, text string, source string")
    kept = quality_rules.keep_documents(docs).groupBy("source").count().collect()
    want = {h: n - fails for h, (n, fails) in sizes.items() if n > fails and h != "sure"}
    assert {r["source"]: r["count"] for r in kept} == {**want, None: 1}


@pytest.mark.parametrize("strength", [5, 40])
def test_prior_leaves_out_the_spread_by_chance(strength):
    rng = np.random.default_rng(7)
    n = rng.integers(2, 12, 20_000)
    rate = rng.binomial(n, rng.beta(0.2 * strength, 0.8 * strength, len(n))) / n
    got = quality_rules.prior_strength(rate.mean(), rate.var(ddof=1), (1 / n).mean())
    assert 0.8 * strength < got < 1.25 * strength
    raw = rate.mean() * (1 - rate.mean()) / rate.var(ddof=1) - 1
    assert raw < 0.7 * strength


def test_prior_without_spread():
    lowest, highest = quality_rules.MIN_PRIOR, quality_rules.MAX_PRIOR
    assert quality_rules.prior_strength(None, None, None) == lowest  # no host
    assert quality_rules.prior_strength(0.3, None, 0.1) == lowest  # one host
    assert quality_rules.prior_strength(0.3, 0.2, 1.0) == lowest  # one row each
    assert quality_rules.prior_strength(0.3, 0.001, 0.1) == highest  # less than by chance
    assert quality_rules.prior_strength(0.0, 0.0, 0.1) == quality_rules.prior_strength(1.0, 0.0, 0.1) == highest


def test_rows_that_repeat_an_id_weigh_as_one(spark):
    texts = [(i, f"{'nasty words' if i % 3 == 0 else 'kind words'} {' '.join(prose(i, 30))}") for i in range(120)]
    plain, many = documents(spark, texts), documents(spark, texts + [texts[i] for i in (0, 1, 3) for _ in range(300)])
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 2)) for i in range(120)], "doc_id long, toxic int, quality int")
    for model in (toxicity, quality_model):
        one, all_ = ({(r["doc_id"], round(r["score"], 9)) for r in model.score(d, labels).collect()} for d in (plain, many))
        assert one == all_ and len(one) == 120


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    toxic = got["toxic"].to_numpy(bool)
    s = got["score"].to_numpy()
    assert ((s >= 0) & (s <= 1)).all()
    pairs = np.sign(s[toxic][:, None] - s[~toxic][None, :])
    assert (pairs.mean() + 1) / 2 > 0.75  # AUC; few of the small table's toxic words are in its training fold
    found = got["predicted"].to_numpy(bool)
    assert (found & toxic).sum() > 0.8 * found.sum()
    folds = {r["doc_id"]: r["held_out"] for r in toxicity.score(docs, labels).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in folds.items())


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    got = toxicity.score(documents(spark, [*EDGE, (None, "x")]), labels).collect()
    assert len(got) == len(EDGE) + 1 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(documents(spark, []).limit(0), labels.limit(0)).count() == 0


def test_non_negative_risk_does_not_fall_below_zero():
    rng = np.random.default_rng(0)
    positive = np.arange(400) < 60
    toxic = positive | (np.arange(400) % 7 == 0)
    present = [np.flatnonzero(np.append(rng.random(30) < 0.1, [t and rng.random() < 0.95])) for t in toxic]
    rows = np.repeat(np.arange(400), [len(p) for p in present])
    w = toxicity.NonNegativePU(0.14, 0).fit(rows, np.concatenate(present), 400, 31, positive)
    assert w[30] > 1 and w[30] > 2 * np.abs(w[:30]).max()


@pytest.mark.parametrize("table", ["labels"])
def test_quality_on_held_out_rows(spark, table):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", table))
    got = quality_model.score(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.95
    assert not set(got["held_out"]) - {True}


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")
    got = quality_model.score(documents(spark, [*EDGE, (None, "x")]), labels).collect()
    assert len(got) == len(EDGE) + 1 and all(0 <= r["score"] <= 1 for r in got)
    assert quality_model.score(documents(spark, []).limit(0), labels.limit(0)).count() == 0


def test_compression_is_of_the_whole_text():
    at = quality_model.STATS.index("compression")
    for n in (0, 1, 16_384, 16_385, 3 * quality_model.PIECE + 1):
        raw = np.random.default_rng(n).bytes(n).hex()[:n].encode()
        assert quality_model.deflated(raw) == len(zlib.compress(raw, 1))
    # junk between the beginnings of the sixteenths of a text
    junk = "".join("a" * 1024 + np.random.default_rng(i).bytes(4096).hex() for i in range(16))
    assert len(junk) > 16_384 and quality_model.statistics(junk)[at] > 0.4
    line = np.random.default_rng(5).bytes(250).hex()
    below, over = (quality_model.statistics((line * 40)[:n])[at] for n in (16_384, 16_400))
    assert abs(below - over) < 0.001


def test_trees_walk_like_a_plain_descent():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > -0.2)).astype(float)
    arrays = quality_model.grow(x, y, trees=15).arrays()
    base, roots, feature, threshold, left, right, value, _ = arrays
    for i in range(0, 900, 90):
        z = base
        for n in roots:
            while feature[n] >= 0:
                n = left[n] if x[i, feature[n]] <= threshold[n] else right[n]
            z += value[n]
        assert np.isclose(z, quality_model.walk(arrays, x[i:i + 1])[0])
    assert (((quality_model.walk(arrays, x) > 0) == y).mean()) > 0.95
    assert json.dumps(quality_model.STATS) and len(quality_model.statistics(None)) == len(quality_model.STATS)
