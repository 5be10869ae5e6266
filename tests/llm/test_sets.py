"""Shingles, the Jaccard join, components: against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.by_value import by_value
from vintagecast.llm import set_join
from vintagecast.llm.components import components
from vintagecast.llm.shingles import shingle_sets

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def brute_set(text, k=5):
    w = WORD.findall((text or "").encode().translate(LOWER))
    if len(w) >= k:
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def brute_components(docs):
    """(doc_id -> component) of rows with an id; rows that share one are one node."""
    sets = [(d, brute_set(t)) for d, t in docs if d is not None]
    up = {d: d for d, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a_, b_ = find(a), find(b)
                up[max(a_, b_)] = min(a_, b_)
    return {d: find(d) for d, _ in sets}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbÉé \t\n\x0b\x1c ", max_size=40)), max_size=8))
def test_shingle_sets_are_the_sets_of_words(texts):
    got = list(shingle_sets(pa.array(texts, pa.string())))
    want = [brute_set(t) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


def test_block_pairs_keeps_every_similar_pair():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = np.sort(rng.integers(1, 60, 150))
        place = rng.integers(0, n)
        got = {(int(a), int(b)) for i, j in set_join.block_pairs(n, place, 8) for a, b in zip(i, j)}
        for i in range(150):
            for j in range(i + 1, 150):
                first = place[i] < set_join.index_length(n[i]) or n[i] == n[j] and place[j] < set_join.index_length(n[j])
                near = 100 * n[i] >= 75 * n[j] and min(n[i] - place[i], n[j] - place[j]) >= set_join.overlap_needed(n[i], n[j])
                assert ((i, j) in got) == bool(first and near)


def test_reach_spans_the_components():
    rng = random.Random(3)
    for _ in range(15):
        base = list(range(60))
        sets = []
        for _ in range(40):
            own = [x if rng.random() < 0.93 else rng.randrange(1000) for x in base[: rng.randrange(30, 60)]]
            sets.append(np.unique(np.array(own, np.uint64)))
        up = list(range(40))

        def find(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        want = {(i, j) for i in range(40) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
        links = set_join.reach(sets)
        assert {(max(p), min(p)) for p in links} <= want
        for i, j in links:
            up[find(i)] = find(j)
        assert all(find(i) == find(j) for i, j in want)


def near_copies(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6)))
    passage = " ".join(word() for _ in range(20))
    docs = []
    for g in range(6):
        base = [word() for _ in range(rng.randrange(12, 120))]
        for _ in range(rng.choice([1, 2, 5, 45])):
            own = [w if rng.random() > 0.02 else word() for w in base]
            text = " ".join(own) + (" " + passage if g % 2 else "")
            docs.append(text.upper() if rng.random() < 0.2 else text.replace(" ", "\n", 1))
    docs += [passage, passage + " end", "one", "One", "two words", "", " \t", None, "x " * 500, "x " * 600]
    return docs


def test_components_against_brute_force(spark):
    texts = near_copies()
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[0]), (None, None)]
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n long")
    got = set_join.jaccard_components(frame).collect()
    want = brute_components(docs)
    assert len(got) == len(docs)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
    sizes = sorted((d is None, d, len(brute_set(t))) for d, t in docs)
    assert sorted((r["doc_id"] is None, r["doc_id"], r["n_shingles"]) for r in got) == sizes


def test_crowds_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(set_join, "CROWD_BLOCK", 8)
    monkeypatch.setattr(set_join, "SPOKES", 2)
    docs = list(enumerate(near_copies(9)))
    got = set_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(docs)


def test_a_large_crowd_is_met_hub_first(spark, monkeypatch):
    """Members near the hub, far ones among themselves and between both."""
    monkeypatch.setattr(set_join, "CROWD_BLOCK", 16)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for i in range(150):  # a chain: each third differs more from the base
        own = list(base)
        for _ in range(i % 3 * 2):
            own[rng.randrange(80)] = f"v{rng.randrange(6)}"
        texts.append(" ".join(own))
    texts += [" ".join(base[:40] + [f"u{i % 4}{j}" for j in range(40)]) for i in range(30)]  # share a passage only
    docs = list(enumerate(texts))
    moved = []
    real = set_join.with_texts
    monkeypatch.setattr(set_join, "with_texts", lambda wanted, classes, docs, name: moved.append((name, wanted.count())) or real(wanted, classes, docs, name))
    got = set_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(docs)
    asked = sum(n for name, n in moved if name == "crowd-hubs")
    assert asked >= 100  # many of these are far from the hub: how often they move isn't bound here


def test_sets_that_share_half_a_fingerprint(spark, monkeypatch):
    real = set_join.fingerprint
    monkeypatch.setattr(set_join, "fingerprint", lambda s: (len(s) % 7, real(s)[1]))
    docs = list(enumerate(near_copies(3)))
    with by_value(set_join):
        got = set_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(docs)


def test_near_dedup_keeps_one_of_each(spark):
    docs = list(enumerate(near_copies(2)))
    frame = spark.createDataFrame([(d, t, "s") for d, t in docs] + [(None, "z", "s")], "doc_id long, text string, source string")
    got = set_join.near_dedup(frame)
    assert got.columns == frame.columns
    assert sorted(r["doc_id"] for r in got.collect() if r["doc_id"] is not None) == sorted(set(brute_components(docs).values()))
    assert got.where("doc_id IS NULL").count() == 1


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert set_join.jaccard_components(empty).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 240)] + [(5, 5), (None, 3)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 240)]}
