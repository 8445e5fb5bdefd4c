from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from snapmart.llm import packing
from snapmart.llm.queries import tokenizer_path
from tests.llm.spark_fixture import EDGE_ROWS, docs_of, with_clashing_columns


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def test_word_ids_are_the_tokenizers_ids(plain, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 40)
    words = packing.WordTokenizer(tokenizer_path(), 1)
    rnd = random.Random(2)
    pieces = ["Hello", "don't", "it's", "a.b", "x_y", "12", "3rd", "é", "é", "ΣΑΣ", "İ", "½", "***", "&&", ",", ".", "'", "'ll", "ß", "漢字", "\U0001f600", " ", " ", "\x1c", "\x85", "\t", "\n", " ", "  ", "Ångström", "<|endoftext|>", "­", "ǅ", "ﬁ"]
    for _ in range(1500):
        text = "".join(rnd.choices(pieces, k=rnd.randrange(10)))
        assert words.encode(text) == np.array([*plain.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes(), repr(text)


def test_every_code_point_is_cut_alike(plain):
    words = packing.WordTokenizer(tokenizer_path(), 1)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}1{c} '{c}s {c}" for c in points[at : at + 512]) for at in range(0, len(points), 512)]
    want = [np.array([*e.ids, 1], "<u4").tobytes() for e in plain.encode_batch_fast(texts, add_special_tokens=False)]
    assert [i for i, (a, b) in enumerate(zip(words.encode_many(texts), want, strict=True)) if a != b] == []


def test_special_tokens_as_the_tokenizer_does(plain):
    words = packing.WordTokenizer(tokenizer_path(), 1)
    texts = ["end <|endoftext|> start", "a<|startoftext|>b", "plain", "<|end of text|>"]
    got = [np.frombuffer(x, "<u4").tolist() for x in words.encode_many(texts)]
    assert got == [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert got[0] == [806, 49407, 1572, 1]
    as_text = packing.WordTokenizer(tokenizer_path(), 1, special_as_text=True)
    other = Tokenizer.from_file(tokenizer_path())
    other.encode_special_tokens = True
    assert [np.frombuffer(x, "<u4").tolist() for x in as_text.encode_many(texts)] == [[*other.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_memory_keeps_words_met_again(plain, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 60)
    words = packing.WordTokenizer(tokenizer_path(), 1)
    rnd = random.Random(7)
    for k in range(60):
        text = "the of and " + " ".join(f"x{rnd.randrange(10**6)}y" for _ in range(rnd.randrange(12)))
        assert words.encode(text) == np.array([*plain.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert k == 0 or {"the", "of", "and"} <= words.known.keys()
    assert len(words.common) <= 30


def check(rows, docs, plain, window=2048):
    """Every id once, sequences gapless, right checksums."""
    ids = defaultdict(list)
    for i, t in docs:
        ids[i].append(np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert by_doc.keys() == ids.keys()
    for i, texts in ids.items():
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        assert sum(r.length for r in pieces) == sum(len(t) for t in texts)
        for r in pieces:
            assert any(len(t) == r.doc_tokens and zlib.crc32(t[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for t in texts)
        if len(texts) == 1:
            assert [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
    short = 0
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r.offset)
        at = 0
        for r in pieces:
            assert r.offset == at
            at += r.length
        assert at <= window
        short += at < window
    assert sorted(by_seq) == list(range(len(by_seq)))
    return short


def test_driver_documents(spark, sf_small, plain):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = packing.pack(docs, tokenizer_path()).collect()
    assert check(rows, [(r.doc_id, r.text) for r in docs.collect()], plain) <= 1
    again = packing.pack(docs.repartition(5), tokenizer_path()).collect()
    assert sorted(rows) == sorted(again)


def by_window(pieces, source):
    held = defaultdict(lambda: defaultdict(int))
    for p in pieces:
        held[p.sequence_id][source[p.doc_id]] += p.length
    return held


def three_sources(n, seed):
    rnd = random.Random(seed)
    return [(i, " ".join(rnd.choices(["red", "green", "blue"], k=rnd.randrange(50, 900))), rnd.choice("aaaabc")) for i in range(n)]


def test_windows_keep_the_mixture(spark, plain):
    rows = three_sources(600, 4)
    pieces = packing.pack(docs_of(spark, rows), tokenizer_path(), part_tokens=40_000).collect()
    parts = check(pieces, [(r[0], r[1]) for r in rows], plain)
    total = sum(p.length for p in pieces)
    assert parts <= -(-total // 40_000)
    source = {r[0]: r[2] for r in rows}
    share = defaultdict(int)
    for p in pieces:
        share[source[p.doc_id]] += p.length
    full = [h for h in by_window(pieces, source).values() if sum(h.values()) == 2048]
    off = [abs(h[s] - 2048 * share[s] / total) for h in full for s in share]
    assert np.mean(off) < 150  # of 2048: 7 % of a window


@pytest.mark.parametrize(("first", "second"), [(0.25, 0.75), (0.75, 0.25)])
def test_windows_follow_their_targets(spark, plain, first, second):
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choices(["red", "green"], k=rnd.randrange(50, 700))), rnd.choice(["x", None])) for i in range(600)]
    source = {r[0]: r[2] for r in rows}
    pieces = packing.pack(docs_of(spark, rows), tokenizer_path(), part_tokens=40_000, targets={"x": first, None: second}).collect()
    check(pieces, [(r[0], r[1]) for r in rows], plain)
    held = by_window(pieces, source)
    small = "x" if first > second else None
    size = sum(p.length for p in pieces if source[p.doc_id] == small)
    # Until the queue of the larger target has run out, windows keep to the targets.
    steady = int(size / max(first, second) / 2048 * 0.9)
    shares = [held[k]["x"] / 2048 for k in range(steady) if sum(held[k].values()) == 2048]
    assert abs(np.mean(shares) - first) < 0.03
    assert np.mean([abs(s - first) for s in shares]) < 0.08
    # Then only the other one is left.
    late = [held[k]["x"] / sum(held[k].values()) for k in sorted(held)[-5:]]
    assert np.mean(late) == (0.0 if small == "x" else 1.0)


def test_sources_without_a_target_come_last(spark, plain):
    rows = three_sources(300, 5)
    source = {r[0]: r[2] for r in rows}
    pieces = packing.pack(docs_of(spark, rows), tokenizer_path(), part_tokens=20_000, targets={"b": 1.0}).collect()
    check(pieces, [(r[0], r[1]) for r in rows], plain)
    held = by_window(pieces, source)
    done = max(k for k, h in held.items() if h["b"])
    assert done <= sum(h["b"] for h in held.values()) / 2048 * 1.2 + 12  # one part of ten windows may be mixed
    empty = packing.pack(docs_of(spark, rows), tokenizer_path(), targets={}).collect()
    check(empty, [(r[0], r[1]) for r in rows], plain)


def test_whole_deficits_are_carried_into_a_part():
    def run(opening):
        queues = {s: [(k, bytes(4 * 100)) for k in range(400)] for s in "ab"}
        got = defaultdict(lambda: defaultdict(int))
        for s in queues:
            queues[s] = [((s, k), ids) for k, (_, ids) in enumerate(queues[s])]
        for doc_id, _, ids, _, number, _ in packing.fill_windows(queues, opening, {"a": 0.5, "b": 0.5}, window=2000, min_piece=50):
            got[number][doc_id[0]] += len(ids) // 4
        return got

    even, behind = run({"a": 0.0, "b": 0.0}), run({"a": 8000.0, "b": -8000.0})
    first = lambda got: sum(got[k]["a"] for k in range(20))
    assert abs(first(even) - 20_000) <= 100
    # 8000 of 40 windows' tokens: half of it is made up for in half of the windows.
    assert abs(first(behind) - 24_000) <= 100


def test_running_sums_in_two_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "SPAN", 4)
    rnd = random.Random(3)
    rows = [(s, k, rnd.randrange(100)) for s in ("a", None) for k in range(0, 40, 3)]
    got = packing.running_before(spark.createDataFrame(rows, "source string, part bigint, n bigint"), "n", "part", ["source"], "before").collect()
    assert sorted([(r.source or "", r.part, r.before) for r in got]) == sorted((s or "", k, sum(n for t, j, n in rows if t == s and j < k)) for s, k, _ in rows)


def test_edge_rows(spark, plain):
    docs = with_clashing_columns(docs_of(spark, EDGE_ROWS))
    rows = packing.pack(docs, tokenizer_path(), part_tokens=5000).collect()
    check(rows, [(r[0], r[1]) for r in EDGE_ROWS], plain)
    assert packing.pack(docs.limit(0), tokenizer_path()).collect() == []


def test_pieces_with_ids(spark, plain):
    docs = docs_of(spark, [(1, "some words to pack", "a")])
    (row,) = packing.pack(docs, tokenizer_path(), with_ids=True).collect()
    assert np.frombuffer(row.ids, "<u4").tolist() == [*plain.encode("some words to pack", add_special_tokens=False).ids, 1]


def test_a_text_may_hold_more_words_than_the_memory(plain, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 40)
    words = packing.WordTokenizer(tokenizer_path(), 1)
    short = " ".join(f"known{chr(97 + i)}" for i in range(15))
    long = short + " " + " ".join(f"{chr(97 + i)}{chr(97 + j)}word {i}-x{j}" for i in range(10) for j in range(10))
    for text in (short, long, short, long + " " + short):
        assert words.encode(text) == np.array([*plain.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()
