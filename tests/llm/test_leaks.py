"""Decontamination by suffix arrays against window sets, word by word."""

import hashlib
import random
import re

import numpy as np
import pytest

from tests.llm.by_value import by_value
from vintagecast.llm import suffix_array
from vintagecast.llm.words import hashes, places

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


def expected(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        words, hit, names, best = words_of(text), set(), set(), {}
        for item, said in items:
            w, name = words_of(said), "" if item is None else str(item)
            n = min(window, len(w))
            for i in range(len(w) - n + 1 if n else 0):
                for j in range(len(words) - n + 1):
                    if words[j : j + n] == w[i : i + n]:
                        hit |= set(range(j, j + n))
                        names.add(name)
                        more = n
                        while i + more < len(w) and j + more < len(words) and w[i + more] == words[j + more]:
                            more += 1
                        best[name] = max(best.get(name, 0), more)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(names), digest, bool(hit), tuple(sorted(best.items()))))
    return sorted(out, key=repr)


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = suffix_array.contamination(d, b, **kw)
    longest = {}
    for r in rows.collect():
        longest.setdefault(r["doc_id"], []).append(tuple(sorted((m["item"], m["words"]) for m in r["matches"])))
    got = [tuple(r) for r in suffix_array.digest(rows).collect()]
    return sorted(((*r, longest[r[0]].pop() if len(longest[r[0]]) == 1 else longest[r[0]][0]) for r in got), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_equals_windows(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(suffix_array, "BLOCK_BYTES", [1 << 20, 300, 100][seed])
    monkeypatch.setattr(suffix_array, "SHARD_BYTES", [1 << 20, 700, 1][seed])
    vocabulary = ["a", "B", "cc", "Ä", "ä", "9", "d9", "日本", "x" * 600]
    say = lambda n: rng.choice([" ", ", ", "\n", "-"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(8)] + [(3, say(12)), (None, say(14)), (20, None), (21, ""), (3, say(11))]
    items.append(items[4])
    docs = [(i, say(rng.choice([0, 5, 20, 60]))) for i in range(25)]
    for i in range(25, 45):
        a, b = rng.choice(items)[1] or "", rng.choice(items)[1] or ""
        docs.append((i, f"{say(4)} {a} {say(3)} {b} {b}"))
    docs += [(45, None), (46, ""), (47, " .,; "), (None, say(30))]
    with by_value(suffix_array):
        assert found(spark, docs, items) == expected(docs, items)


def test_passage_shared_by_many_and_repeated_rows(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = [(i, passage if i % 2 else f"x{i} {passage} y{i}") for i in range(300)] + [(7, passage)] * 3
    got = found(spark, docs, [(1, passage)] * 5 + [(2, " ".join(passage.split()[5:16]))])
    assert got == expected(docs, [(1, passage), (2, " ".join(passage.split()[5:16]))])


def test_a_passage_does_not_run_over_texts(spark):
    item = " ".join(f"w{i}" for i in range(10))
    docs = [(1, "w0 w1 w2 w3 w4"), (2, "w5 w6 w7 w8 w9"), (3, item)]
    assert [r[2] for r in found(spark, docs, [(1, item)])] == [0, 0, 10]


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b")]) == []
    assert [r[2:6] for r in found(spark, [(1, "a b")], [])] == [(0, 0, hashlib.sha256(b"").hexdigest(), False)]


def test_very_long_text(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"v{i}" for i in range(500)])[rng.integers(0, 500, 400_000)]
    item = [f"q{i}" for i in range(15)]
    text = " ".join([*words[:200_000], *item, *words[200_000:]])
    got = found(spark, [(1, text)], [(1, " ".join(item)), (2, " ".join(words[100:112]))])
    assert got[0][1:4] == (400_015, 27, 2)


def test_documents_with_hits_go(spark):
    item = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, "clean text", "x"), (2, f"say {item} so", "y"), (None, None, None), (2, "clean again", "z")], "doc_id long, text string, rest string")
    left = suffix_array.decontaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert left.columns == docs.columns
    assert sorted((tuple(r) for r in left.collect()), key=repr) == sorted([(1, "clean text", "x"), (None, None, None), (2, "clean again", "z")], key=repr)


@pytest.mark.parametrize("size,letters", [(1, 2), (50, 2), (300, 3), (2000, 50)])
def test_suffix_array_is_sorted(size, letters):
    rng = np.random.default_rng(size)
    text = rng.integers(0, letters, size)
    for depth in (1, 3, 70, 5000):
        order, *_ = suffix_array.suffix_array(text, depth)
        assert sorted(order.tolist()) == list(range(size))
        padded = np.concatenate([text, np.zeros(depth, text.dtype)])
        tails = [tuple(padded[i : i + depth]) for i in order]
        assert all(a <= b for a, b in zip(tails, tails[1:]))


def test_word_hashes_over_blocks():
    text = ("Aa bB ä " * 200_000 + "x" * 3_000_000 + " aA Bb").encode()
    data = np.frombuffer(text, np.uint8)
    starts, ends, at = places(data, np.array([0, len(data)]), suffix_array.WORD)
    h = hashes(data, starts, ends)
    assert len(h) == 600_003 and len(set(h.tolist())) == 4
    assert h[0] == h[-2] and h[1] == h[-1] and at.tolist() == [0, 600_003]
