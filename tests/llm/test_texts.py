import random
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loamstack.llm import contamination as K
from loamstack.llm import lookalike as L
from loamstack.llm import packing as P

SAME = [
    ("ＡＢｃ１２", "ABc12"), ("café", "café"), ("ofﬁce", "office"), ("pаper", "paper"), ("a​b﻿­c⁠", "abc"), ("a b c d　e", "a b c d e"), ("ΕΤΑ", "ETA"), ("e​́", "é"), ("ё", "ë"), ("ño", "ño"), ("ｶ", "カ"),
]
APART = [("A", "a"), ("résumé", "resume"), ("x²", "x2"), ("👩‍🔬", "👩🔬"), ("👍🏽", "👍"), ("🏳️‍🌈", "🏳️🌈"), ("к", "k"), ("a b", "a  b"), ("й", "и")]


@pytest.mark.parametrize("a,b", SAME)
def test_reads_the_same(a, b):
    assert L.visual_form(a) == L.visual_form(b) == b


@pytest.mark.parametrize("a,b", APART)
def test_looks_different(a, b):
    assert L.visual_form(a) != L.visual_form(b)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_form_is_stable(t):
    f = L.visual_form(t)
    assert L.visual_form(f) == f
    assert L.visual_form(unicodedata.normalize("NFD", unicodedata.normalize("NFC", t))) == L.visual_form(unicodedata.normalize("NFC", t))


@pytest.mark.parametrize("a,b", [("\u13aa", "A"), ("\u13b3", "W"), ("\u217c", "l"), ("\u2167", "VIII"), ("\u2c9f", "o"), ("\u0261", "g"), ("\ua4d0", "B"), ("x\u200d\u0301", "x\u0301"), ("\u1112\u1161\u11ab", "\ud55c"), ("\ud558\u11ab", "\ud55c"), ("\u2764\ufe0f\ufe0f", "\u2764\ufe0f")])
def test_more_that_reads_the_same(a, b):
    assert L.visual_form("q" + a + "z") == "q" + b + "z"


@pytest.mark.parametrize("a", ["\U0001f469\u200d\U0001f4bb", "1\ufe0f\u20e3", "\U0001f44d\U0001f3fd", "\u2764\ufe0f\u200d\U0001f525", "x\u00b2", "\U0001d400"])
def test_clusters_kept_as_they_are(a):
    assert L.visual_form(a) == a and L.visual_form(a) != L.visual_form(a.replace("\u200d", ""). replace("\ufe0f", "").replace("\U0001f3fd", "") + "y")


def test_same_look_classes(spark):
    rows = [(1, "A b"), (2, "\uff21 b"), (3, "\uff21 b"), (4, "a b"), (5, None), (6, "")]
    got = sorted((r.first_id, r.rows) for r in L.same_look_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1), (2, 2)]


def test_same_look_pairs(spark):
    rows = [(1, "paper café", "x"), (2, "pаper café", "x"), (3, "paper café", None), (4, None, "x"), (5, None, "x"), (6, "", "x"), (7, "​", "x"), (8, "Paper café", "x"), (9, "a" * 500_000, "x"), (10, "a" * 500_000 + "​", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string")
    got = sorted((r.id_a, r.id_b) for r in L.same_look_pairs(df).collect())
    assert got == [(1, 2), (2, 3), (6, 7), (9, 10)]
    assert L.same_look_pairs(df.limit(0)).count() == 0


# --- packing -----------------------------------------------------------------------------------------------------------


def slow_best_fit(sizes, cap, sep):
    bins = []
    for n in sizes:
        fit = [b for b in bins if cap - b >= n + sep]
        if fit:
            i = bins.index(max(fit))
            bins[i] += n + sep
        else:
            bins.append(n)
    return bins


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_equals_search(seed):
    r = random.Random(seed)
    sizes = [r.randint(1, 100) for _ in range(400)]
    b = P.BestFit(100, 1, 10**6)
    for n in sizes:
        b.place(n)
    assert sorted(b.still_open().values()) == sorted(slow_best_fit(sizes, 100, 1))


def test_few_open_and_fullest_closes():
    b = P.BestFit(10, 0, 2)
    assert [b.place(n)[0] for n in (6, 7, 8)] == [0, 1, 2]  # the one with 7 was the fullest and is closed
    assert b.still_open() == {0: 6, 2: 8} and b.place(3)[0] == 0


def test_pack_whole(spark):
    r = random.Random(1)
    rows = [(i, r.choice([0, None, r.randint(1, 60), r.randint(1, 500)]), "x") for i in range(2000)] + [(5000, 40, "x")] * 3
    specs = spark.createDataFrame([("s", 100, 1), ("m", 256, 0)], "spec_name string, capacity_tokens int, separator_tokens int")
    df = spark.createDataFrame(rows, "doc_id long, tokens long, container string").repartition(5)
    got = P.pack(df, specs, most_open=8).collect()
    for name, cap, sep in (("s", 100, 1), ("m", 256, 0)):
        mine = [g for g in got if g.spec_name == name]
        assert sum(g.tokens for g in mine) == sum(n or 0 for _, n, _ in rows)
        by = {}
        for g in mine:
            by.setdefault(g.container, []).append(g)
        for items in by.values():
            assert sum(x.tokens for x in items) + sep * (len(items) - 1) <= cap
            assert sorted(x.position for x in items) == list(range(len(items)))
        sizes = {i: n for i, n, _ in rows}
        for g in mine:
            assert (g.piece == 0 and g.first_token == 0 and g.tokens == sizes[g.doc_id]) if sizes[g.doc_id] <= cap else g.first_token == g.piece * cap
        assert len(by) <= 1.15 * sum(n or 0 for _, n, _ in rows) / cap + 1
    assert P.pack(df.limit(0), specs).count() == 0
    assert P.pack(df, specs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        P.pack(df, spark.createDataFrame([("z", 0, 0)], specs.schema))


def test_token_count(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "a " * 200_000)], "doc_id long, text string")
    assert [r[0] for r in df.select(P.token_count(spark, F.col("text"))).collect()][:3] == [2, 0, None]
    assert P.encoding(P.vocabulary()).decode(P.encoding(P.vocabulary()).encode_ordinary("Zürich 12 {x}\n")) == "Zürich 12 {x}\n"


# --- leaked passages ---------------------------------------------------------------------------------------------------


def test_leaks_equal_brute_force(spark):
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    common = "solve the following problem step by step and then"
    items = [(i, common + " " + " ".join(r.choice(vocab) for _ in range(30)), "z") for i in range(12)] + [(50, "too short", "z"), (51, None, "z"), (52, "", "z")]
    docs = []
    for d in range(150):
        words = [r.choice(vocab) for _ in range(r.randint(0, 60))]
        if d % 3 == 0:
            w = items[d % 12][1].split()
            a = r.randint(0, 20)
            words[5:5] = w[a : a + r.randint(9, 18)]
        docs.append((d, r.choice([" ", "\n# ", "_", " -- "]).join(words).upper() if d % 2 else common + " " + " ".join(words), None))
    docs += [(900, None, "q"), (901, "", "q"), (902, docs[0][1], "q"), (903, "x " * 200_000 + items[0][1].replace("w", "ｗ") + " y", "q")]
    got = K.find_leaks(spark.createDataFrame(docs, "doc_id long, text string, item_id string"), spark.createDataFrame(items, "item_id int, passage string, kind string"))
    grams = {}
    for i, p, _ in items:
        w = K.word_hashes(p or "").tolist()
        for k in range(len(w) - 12):
            grams.setdefault(tuple(w[k : k + 13]), set()).add(i)
    want = set()
    for d, t, _ in docs:
        w = K.word_hashes(t or "").tolist()
        for k in range(len(w) - 12):
            want |= {(d, i) for i in grams.get(tuple(w[k : k + 13]), ())}
    rows = got.collect()
    assert {(x.doc_id, x.item_id) for x in rows if x.longest_run >= 13} == want and (903, 0) in want
    assert len(rows) == len({(x.doc_id, x.item_id) for x in rows})


def test_edited_copies_are_found(spark):
    w = [f"w{k}" for k in range(40)]
    every = {9: [x if k % 9 else "other" for k, x in enumerate(w)], 7: [x for k, x in enumerate(w) if k % 7]}
    docs = [(1, " ".join(every[9])), (2, "a b c " + " ".join(every[7]) + " d e"), (3, " ".join(w)), (4, " ".join(w[:12]))]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(w))], "item_id int, passage string")
    got = {r.doc_id: (r.longest_run, r.score) for r in K.find_leaks(d, i).collect()}
    assert set(got) == {1, 2, 3} and got[1][0] == 8 and got[2][0] == 6 and got[3] == (40, 80)
    assert [r.doc_id for r in K.find_leaks(d, i, edited=False).collect()] == [3]


def test_pairs_aligned_together_score_as_alone():
    r = np.random.default_rng(1)
    a, b = ([r.integers(0, 9, r.integers(0, m)).astype(np.uint64) for _ in range(60)] for m in (14, 40))
    assert K.align_pairs(a, b, cells=100) == [K.align(x, y) for x, y in zip(a, b)]
    assert K.align_pairs([], []) == []


def test_align_scores_edits():
    a, b = np.arange(1, 31, dtype=np.uint64), np.arange(1, 31, dtype=np.uint64)
    assert K.align(a, b) == (30, 60)
    b = np.delete(b, 10)
    assert K.align(a, b) == (19, 57)
    assert K.align(a, np.array([], np.uint64)) == (0, 0)
    r = np.random.default_rng(0)
    for _ in range(20):
        x, y = r.integers(0, 5, 12).astype(np.uint64), r.integers(0, 5, 15).astype(np.uint64)
        h = np.zeros((13, 16), int)
        for i in range(12):
            for j in range(15):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if x[i] == y[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert K.align(x, y)[1] == h.max()


def test_no_leaks_in_empty(spark):
    d, i = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b c")], "item_id int, passage string")
    assert K.find_leaks(d, i).count() == 0
    assert K.find_leaks(spark.createDataFrame([(1, "a b c")], d.schema), i.limit(0)).count() == 0


@pytest.mark.parametrize("rate", [0.05, 0.15, 0.3])
def test_edited_copies_are_found(spark, rate):
    """Passages with words dropped, replaced and added: all of them, and no pair of texts that share nothing."""
    r = random.Random(9)
    words = [f"w{k}" for k in range(4000)]
    items = [(k, " ".join(r.choice(words) for _ in range(80))) for k in range(12)]
    rows = []
    for k, passage in items:
        out = []
        for x in passage.split():
            u = r.random()
            out += [] if u < rate / 3 else [r.choice(words)] if u < 2 * rate / 3 else [x, r.choice(words)] if u < rate else [x]
        rows.append((k, " ".join(r.choice(words) for _ in range(50)) + " " + " ".join(out)))
    rows += [(100 + k, " ".join(r.choice(words) for _ in range(150))) for k in range(20)]
    got = {(x.doc_id, x.item_id) for x in K.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, passage string")).collect()}
    assert got == {(k, k) for k, _ in items}


def test_packing_keeps_its_rules(spark):
    sizes = spark.createDataFrame([(k, (k * 37) % 90 + 1) for k in range(500)] + [(900, None), (901, 0), (902, 1000)], "doc_id long, tokens long").repartition(3)
    specs = spark.createDataFrame([("s", 100, 1), ("m", 256, None)], "spec_name string, capacity_tokens int, separator_tokens int")
    got = P.violations(P.pack(sizes, specs, most_open=8), sizes, specs).collect()
    assert sorted(tuple(r) for r in got) == [("m", 501, 0, 0, 0), ("s", 501, 0, 0, 0)]
    bad = P.pack(sizes, specs).withColumn("tokens", F.when(F.col("doc_id") == 3, 99).otherwise(F.col("tokens")))
    assert all(r.wrong_total == 1 for r in P.violations(bad, sizes, specs).collect())
