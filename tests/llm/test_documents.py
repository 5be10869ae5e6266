"""Exact dedup, mixing, language identification."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagecast.llm import exact_dedup, language_id, mixing

SPACE = re.compile("[\x20\x09-\x0d]")


def brute_dedup(rows):
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[SPACE.sub("", t or "")].append((-len(t or ""), d is None, d or 0, i))
    out = Counter()
    for text, members in groups.items():
        best = min(members)
        for m in members:
            d, keep = rows[m[3]][0], rows[best[3]][0]
            out[(d, keep, len(members), m[3] == best[3], hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


def copies():
    rng = random.Random(4)
    long = " ".join("".join(rng.choice("abcdeé") for _ in range(6)) for _ in range(9000))
    texts = ["a b", "ab", "a  b", "a\tb\n", "", None, " \n", "ab ", "é", "é", " ", long, long.replace(" ", "\n"), long + "x", "x" + long, long.replace("a", "b", 1)]
    return list(enumerate(texts)) + [(1, "ab"), (None, "ab"), (20, "ab  cd   "), (3, "a\tb\n")]


def test_exact_groups(spark):
    rows = copies()
    got = exact_dedup.exact_groups(spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, keys string"))
    have = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got.collect())
    assert sum(have.values()) == len(rows)
    assert {k[:3] + k[4:]: sum(v for q, v in have.items() if q[:3] + q[4:] == k[:3] + k[4:]) for k in have} == {
        k[:3] + k[4:]: sum(v for q, v in brute_dedup(rows).items() if q[:3] + q[4:] == k[:3] + k[4:]) for k in brute_dedup(rows)
    }
    assert have == brute_dedup(rows)


def test_exact_groups_where_keys_clash(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "verified", lambda rows: spark.range(1).selectExpr("id AS key"))
    rows = copies()
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got.collect()) == brute_dedup(rows)


def test_verified_finds_keys_of_two_contents(spark):
    rows = spark.createDataFrame([([1, 2], [b"a", b"b"]), ([2, 3], [b"c", b"d"]), ([1], [b"a"])], "keys array<long>, digests array<binary>")
    assert [r["key"] for r in exact_dedup.verified(rows).collect()] == [2]


def test_chunks_hang_on_content_only():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, 200_000).astype(np.uint8)
    b = np.concatenate((rng.integers(0, 256, 777).astype(np.uint8), a))

    def chunks(x):
        ends = exact_dedup.chunk_ends(exact_dedup.cut_points(x), 0, len(x))
        assert ends[-1] == len(x) and max(np.diff([0, *ends])) <= exact_dedup.MOST
        return {x[s:e].tobytes() for s, e in zip([0, *ends], ends)}

    assert len(chunks(a) & chunks(b)) > 0.9 * len(chunks(a))


def test_exact_dedup_keeps_rows_with_all_columns(spark):
    rows = [(d, t, "en", "s") for d, t in copies()]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = exact_dedup.exact_dedup(frame)
    assert got.columns == frame.columns
    want = Counter({(k[0], k[4]): v for k, v in brute_dedup([r[:2] for r in rows]).items() if k[3]})
    assert Counter((r["doc_id"], hashlib.sha256(SPACE.sub("", r["text"] or "").encode()).hexdigest()) for r in got.collect()) == want
    assert exact_dedup.exact_groups(frame.limit(0)).count() == 0


def brute_targets(sizes, weights, cap):
    budget = sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, target = set(), {}
    while True:
        rest = [s for s in order if s not in full]
        left = budget - sum(cap * sizes[s] for s in full)
        total = sum(w[s] for s in rest)
        over = [s for s in rest if left * w[s] / total > cap * sizes[s]] if total else []
        for s in rest:
            target[s] = left * w[s] / total
        if not over:
            return {s: cap * sizes[s] if s in full else target[s] for s in order}
        full |= set(over)


def test_mix(spark):
    rng = random.Random(6)
    rows = []
    for i in range(3000):
        s = rng.choice(["b", "b", "b", "b", "b", "a", "é", "Z", None, "tiny"]) if i % 50 else "rare"
        n = rng.randrange(0, 60) if s != "tiny" else rng.randrange(0, 2)
        rows.append((i, " \t".join(["w"] * n) if rng.random() > 0.02 else None, s, 1))
    rows += [rows[0], (None, "a b c", "b", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    got = mixing.mix(frame).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes, (5, 2, 1), 3)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["times"] * r["size"]
        taken[r["source"]] += r["taken"]
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 61
    again = mixing.mix(frame.repartition(7)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_documents_repeat_rows(spark):
    rows = [(i, "w " * 20, "big" if i < 60 else "small") for i in range(63)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed_documents(frame)
    assert got.columns == frame.columns
    plan = {r["doc_id"]: r["times"] for r in mixing.mix(frame).collect()}
    assert Counter(r["doc_id"] for r in got.collect()) == Counter({d: n for d, n in plan.items() if n})
    assert max(plan.values()) == 3  # the small source is repeated up to its cap
    empty = frame.limit(0)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    assert all(r["taken"] == 0 for r in mixing.mix(frame.selectExpr("doc_id", "'' AS text", "source")).collect())


SYLLABLES = {"xx": "ka mo ti ru ne sa po".split(), "yy": "schl ung ber ött ver nicht".split(), "zz": "çion eau lle é oui pre".split()}


def said(lang, rng, words=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))).title() for _ in range(words))


def test_trigrams_against_a_loop():
    import pyarrow as pa

    texts = ["Ab, ÀÉ é!", "", None, "a", "..", "x--y zz", "Ö×÷", "ab"]
    for grams, bounds, letters in language_id._blocks(pa.array(texts)):
        n = []
        for t in texts:
            folded = "".join(c if ord(c) > 127 or c.isascii() and c.isalpha() else " " for c in t or "")
            folded = re.sub(" +", " ", folded).encode()
            n.append(folded)
        counts = [max(0, len(x) - (1 if x.startswith(b" ") else 0) - 2) for x in n]
        assert np.diff(bounds).tolist() == counts and len(grams) == sum(counts)
        assert letters.tolist() == [len(x.replace(b" ", b"")) for x in n]


def test_languages_of_held_out_texts(spark):
    rng = random.Random(1)
    rows = [(i, said(lang, rng), lang, f"http://{lang}.example.{lang}/") for i, lang in enumerate(["xx", "yy", "zz"] * 120)]
    held = [(1000 + i, said(lang, rng), None, None) for i, lang in enumerate(["xx", "yy", "zz"] * 30)]
    held += [(2000 + i, said("xx", rng), "yy", "http://xx.example.xx/") for i in range(10)]  # said wrongly by the markup
    odd = [(3000, None, "xx", None), (3001, "", None, ""), (3002, "12 34!", "xx", "s"), (None, said("yy", rng), None, None)]
    noise = [(4000 + i, " ".join("".join(rng.choice("qwjkzxvbp") for _ in range(9)) for _ in range(40)), None, None) for i in range(5)]
    frame = spark.createDataFrame(rows + held + odd + noise, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in language_id.identify_documents(frame).collect()}
    assert len(got) == len(rows) + len(held) + len(odd) + len(noise)
    assert all(got[1000 + i]["language"] == ["xx", "yy", "zz"][i % 3] for i in range(90))
    assert all(got[2000 + i]["language"] == "xx" for i in range(10))
    assert [got[i]["kept"] for i in (3000, 3001, 3002)] == [False] * 3 and got[None]["language"] == "yy"
    assert all(got[4000 + i]["language"] == "und" and not got[4000 + i]["kept"] for i in range(5))
    kept = language_id.identified(frame)
    assert kept.columns == frame.columns and kept.count() == len(rows) + len(held) + 1


def test_short_texts_follow_markup_and_host(spark):
    rng = random.Random(2)
    rows = [(i, said(lang, rng), lang, f"http://h{lang}.example.org/a") for i, lang in enumerate(["xx", "yy", "zz"] * 100)]
    short = [(900, "Q.", "yy", "http://hyy.example.org/b"), (901, "Q.", None, "http://hzz.example.org/b"), (902, "Q.", "xx", None)]
    got = {r["doc_id"]: r["language"] for r in language_id.identify_documents(spark.createDataFrame(rows + short, "doc_id long, text string, lang string, source string")).collect()}
    assert [got[i] for i in (900, 901, 902)] == ["yy", "zz", "xx"]


@pytest.mark.parametrize("rare", [5, 20])
def test_rare_language_beside_a_hot_one(spark, rare):
    rng = random.Random(5)
    rows = [(i, said("xx", rng, 12), "xx", "http://xx.example.xx/") for i in range(30_000)]
    own = [(50_000 + i, said("zz", rng), "zz", None) for i in range(rare)]
    held = [(60_000 + i, said("zz", rng), None, None) for i in range(20)]
    odd = [(70_000 + i, "12 !", "digits", None) for i in range(6)] + [(80_000 + i, said("yy", rng), f"once{i}", None) for i in range(2)]
    noise = [(90_000 + i, " ".join("".join(rng.choice("qwjkzxvbp") for _ in range(9)) for _ in range(40)), None, None) for i in range(5)]
    frame = spark.createDataFrame(rows + own + held + odd + noise, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in language_id.identify_documents(frame).where("doc_id >= 50000").collect()}
    assert all(got[d]["language"] == "zz" and got[d]["kept"] for d, *_ in own + held)
    assert all(got[d]["language"] == "und" and not got[d]["kept"] for d, *_ in noise + odd[:6])
    alone = spark.createDataFrame(own + held, frame.schema)
    assert all(r["language"] == "zz" and r["kept"] for r in language_id.identify_documents(alone).collect())


def test_labels_with_regions_are_one_language(spark):
    rng = random.Random(7)
    rows = [(i, said("xx", rng), ["xx", "xx-US", "XX_gb", None][i % 4 if i % 10 else 3], None) for i in range(1000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = language_id.identify_documents(frame).collect()
    assert len(got) == 1000 and all(r["kept"] and r["language"] == "xx" for r in got)
    assert language_id.identified(frame).count() == 1000


def test_free_text_is_no_label(spark):
    rng = random.Random(9)
    rows = [(i, said("xx", rng, 8), "xx", None) for i in range(50)]
    rows += [(100 + i, said("xx", rng, 8), f"http://example.org/{i % 4000} {i % 3}", None) for i in range(20_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = language_id.identify_documents(frame)
    assert {(r["language"], r["kept"]) for r in found.collect()} == {("xx", True)}
    tags = ["en", "EN-us", "pt_BR", "zh-Hant-TW", " de ", "", None, "english", "e", "und", "mul-x", "en us", "en-"]
    got = spark.createDataFrame([(t,) for t in tags], "t string").select(language_id.primary_subtag(F.col("t"))).collect()
    assert [r[0] for r in got] == ["en", "en", "pt", "zh", "de"] + [None] * 8


def test_language_without_labels_or_rows(spark):
    none = spark.createDataFrame([(1, "some text", None, None)], "doc_id long, text string, lang string, source string")
    assert [r["kept"] for r in language_id.identify_documents(none).collect()] == [False]
    assert language_id.identify_documents(none.limit(0)).count() == 0
