"""Encoding, packing and records: exact round trips."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vintagecast.llm import packing, records
from vintagecast.llm.encode import encoder

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
PLAIN = {n: Tokenizer.from_file(public_tokenizers.path(n)) for n in NAMES}
PIECES = ["the", "The", " ", "  ", "\n", "\n\n", "\t", "'s", "don't", "É", "ñó", "日本", " ", "́", "\x1c", "12", ".", "...", "!!", "$$$", "<|endoftext|>", "<|startoftext|>", "<|", "ﬁ", "İ", "ǅ", "a_b", "—", "x" * 80, "\r\n", "😀"]


def plain(name, text):
    return PLAIN[name].encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), st.text(max_size=30))
def test_encoder_gives_the_librarys_ids(built, free):
    for name in NAMES:
        enc = encoder(public_tokenizers.path(name))
        for text in (built, free, built + free, " ".join((free, built))):
            assert enc.encode(text).tolist() == plain(name, text)


@pytest.mark.parametrize("name", NAMES)
def test_ids_over_all_white_space(name):
    """Every kind of white space and line end, within and between words."""
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()] + ["\u200b", "\ufeff", "\u180e", "\x00", "\x7f"]
    assert len(spaces) > 25
    enc, rng = encoder(public_tokenizers.path(name)), random.Random(8)
    parts = ["a", "the", "B.", "x,", "\n", "\n", " ", "\t", "é", "1"]
    texts = ["".join(rng.choice(spaces if rng.random() < 0.3 else parts) for _ in range(rng.randrange(1, 9))) for _ in range(100_000)] + ["a\tb\n\xa0"]
    for at in range(0, len(texts), 10_000):
        want = PLAIN[name].encode_batch(texts[at : at + 10_000], add_special_tokens=False)
        assert [(t, enc.encode(t).tolist()) for t in texts[at : at + 10_000]] == [(t, w.ids) for t, w in zip(texts[at : at + 10_000], want)]


def test_encoder_forgets_and_stays_right(monkeypatch):
    from vintagecast.llm import encode

    monkeypatch.setattr(encode, "KEPT", 5)
    enc = encode.WordEncoder(public_tokenizers.path(NAMES[0]))
    rng = random.Random(1)
    for _ in range(50):
        text = " ".join("".join(rng.choice("abcdé") for _ in range(3)) for _ in range(20))
        assert enc.encode(text).tolist() == plain(NAMES[0], text)
        assert len(enc.led) < 60


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_best_fit_takes_the_tightest_window(lengths):
    lengths = np.sort(np.array(lengths, np.int64))[::-1]
    where, offset = packing.best_fit(lengths, 32)
    room: dict[int, int] = {}
    for n, w, o in zip(lengths.tolist(), where.tolist(), offset.tolist()):
        fits = [r for r in room.values() if r >= n]
        if fits:
            assert room[w] == min(fits)
        else:
            assert w not in room
        assert o == 32 - room.get(w, 32)
        room[w] = room.get(w, 32) - n
    assert all(r >= 0 for r in room.values())


DOCS = [(i, "erly the wh " * n) for i, n in enumerate([0, 1, 5, 40, 400, 900, 3000, 682, 683, 341])] + [(10, None), (None, "x y"), (3, "x"), (3, "x"), (11, "<|endoftext|> a")]


def test_pack_round_trip(spark):
    name = "word_bpe_49k.json"
    frame = spark.createDataFrame([(d, t, 7) for d, t in DOCS], "doc_id long, text string, piece long")
    packed = packing.pack(frame, public_tokenizers.path(name), with_ids=True)
    rows = packed.collect()
    pieces = defaultdict(Counter)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        pieces[r["doc_id"]][(r["start"], r["doc_tokens"], tuple(ids))] += 1
    want = defaultdict(Counter)
    for d, t in DOCS:
        ids = [*plain(name, t), 1]
        for s in range(0, len(ids), 2048):
            want[d][(s, len(ids), tuple(ids[s : s + 2048]))] += 1
    assert pieces == want
    windows = defaultdict(list)
    for r in rows:
        windows[r["sequence_id"]].append((r["offset"], r["length"], r["ids"]))
    for w in windows.values():
        at = 0
        for o, n, _ in sorted(w):
            assert o == at
            at += n
        assert at <= 2048
    total = sum(len(plain(name, t)) + 1 for _, t in DOCS)
    assert len(windows) == -(-total // 2048)
    for s in packing.sequences(packed).collect():
        assert bytes(s["ids"]) == b"".join(x[2] for x in sorted(windows[s["sequence_id"]]))
        assert [p["offset"] for p in s["spans"]] == [x[0] for x in sorted(windows[s["sequence_id"]])]


def test_pack_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), public_tokenizers.path(NAMES[1])).count() == 0


def test_records_round_trip(spark, tmp_path, monkeypatch):
    name = NAMES[0]
    frame = spark.createDataFrame([(d, t, "p") for d, t in DOCS], "doc_id long, text string, path string").repartition(3)
    folder = f"file://{tmp_path}/rec"
    manifest = records.write_records(frame, public_tokenizers.path(name), folder)
    got = records.read_records(spark, folder, manifest).collect()
    order = sorted(DOCS, key=lambda x: (x[0] is not None, x[0], x[1] is not None, x[1] or ""))
    start, want = 0, []
    for d, t in order:
        ids = np.array([*plain(name, t), 0], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda x: x[1]) == want
    names = [r["path"] for r in manifest.orderBy("part", "number").collect()]
    seen = Counter((d, tuple(ids.tolist())) for d, ids in records.shuffled(folder, names, 5))
    assert seen == Counter((d, (*plain(name, t), 0)) for d, t in DOCS)
    assert [d for d, _ in records.shuffled(folder, names, 5)] == [d for d, _ in records.shuffled(folder, names, 5)]


def test_records_of_no_documents(spark):
    assert records.token_records(spark.createDataFrame([], "doc_id long, text string"), public_tokenizers.path(NAMES[0])).count() == 0


def test_broken_records_are_found():
    data = b"".join(records.frame(records.pack_document(i, np.arange(i * 9), 2)) for i in range(4))
    assert [records.unpack_document(p)[0] for _, p in records.frames(data)] == [0, 1, 2, 3]
    for at in range(len(data)):
        broken = data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]
        with pytest.raises(ValueError):
            list(records.frames(broken))
    with pytest.raises(ValueError):
        list(records.frames(data[:-1]))


def test_uncommitted_files_are_left_out(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    folder = f"file://{tmp_path}/rec"
    manifest = records.write_records(frame, public_tokenizers.path(NAMES[0]), folder)
    (tmp_path / "rec" / "part-000000-0000-lost.rec").write_bytes(records.frame(records.pack_document(9, np.arange(3), 2)))
    assert sorted(r["doc_id"] for r in records.read_records(spark, folder, manifest).collect()) == [1, 2]
