"""Byte-level BPE against the tiktoken library itself."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from snapmart.llm import byte_bpe
from snapmart.llm.queries import BYTE_TOKENIZER, QUERIES, tokenizer_path
from tests.llm.spark_fixture import EDGE_ROWS, docs_of, with_clashing_columns

PATH, PATTERN = tokenizer_path(BYTE_TOKENIZER), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("reference", pat_str=PATTERN, mergeable_ranks=byte_bpe.load_ranks(PATH), special_tokens={})


def reference(library, text):
    ids = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def check(df, rows, library):
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect()), key=repr)
    assert got == sorted(((i, *reference(library, t)) for i, t in rows), key=repr)


def test_whole_table(spark, sf_check, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_check}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op13_byte_bpe"](spark, sf_check), rows, library)


def test_edge_rows(spark, library):
    rows = [*EDGE_ROWS, (8, "end <|endoftext|> start", "a"), (9, "a" * 50_000, "a"), (10, " \n\n  \t x  \x1c\x85\xa0  y", "a")]
    docs = with_clashing_columns(docs_of(spark, rows)).withColumns({n: F.lit("x") for n in ("block", "seq", "body", "sizes", "n_tokens")})
    check(byte_bpe.digests(docs.repartition(3), PATH, PATTERN), [(i, t) for i, t, _ in rows], library)
    assert byte_bpe.digests(docs.limit(0), PATH, PATTERN).collect() == []


def test_small_blocks_and_groups(spark, library, monkeypatch):
    rnd = random.Random(5)
    rows = [(i, "".join(rnd.choices("ab '\n1é\U0001f600.s", k=rnd.randrange(60)))) for i in range(400)]
    monkeypatch.setattr(byte_bpe, "_PART_BLOCKS", 1 << 24)
    cut = byte_bpe.cut_into_words(docs_of(spark, [(i, t, "s") for i, t in rows]).repartition(6), PATTERN)
    assert cut.filter("kind = 0").select("block").distinct().count() == 6
    check(byte_bpe.digests(docs_of(spark, [(i, t, "s") for i, t in rows]).repartition(6), PATH, PATTERN), rows, library)


def test_blocks_end_by_size():
    compiled = regex.compile(PATTERN)
    block = byte_bpe.Block(3)
    row = block.add(compiled, [1, 2], ["a b a", None])
    assert row[:6] == (3, 1, None, 1, [1, 2], [3, 0])
    assert byte_bpe.unpack_numbers(row[6]).tolist() == [0, 1, 2]
    assert list(byte_bpe.chunks([1, 2, 3, 4], ["aa", None, "bbbb", "c"], chars=3)) == [([1, 2], ["aa", None]), ([3], ["bbbb"]), ([4], ["c"])]


def test_a_word_is_encoded_once():
    encoder = byte_bpe.PieceEncoder(PATH, PATTERN)
    calls = []
    merge = encoder.merge
    encoder.merge = lambda w: calls.append(w) or merge(w)
    first, again = encoder.encode([b" the", b"xyz", b" the"]), encoder.encode([b"xyz"])
    assert len(calls) == 2 and first[1] == again[0]


def test_every_code_point_is_cut_alike(library):
    """The pattern gives the same pre-tokens as the library's engine for every code point."""
    compiled = regex.compile(PATTERN)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4096):
        text = "\n".join(f"a{c}1{c}" for c in points[at : at + 4096])
        ids = [i for w in compiled.findall(text) for i in library._encode_single_piece(w)]
        assert ids == library.encode_ordinary(text), hex(at)


def test_ids_decode_by_the_table(spark):
    raw = [np.array(x, "<u4").tobytes() for x in ([0, 50_255, 262], [], [1])]
    df = spark.createDataFrame([(i, r) for i, r in enumerate([*raw, None])], "doc_id int, ids binary")
    table = {v: k for k, v in byte_bpe.load_ranks(PATH).items()}
    want = {0: table[0] + table[50_255] + table[262], 1: b"", 2: table[1], 3: b""}
    assert {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(df, PATH).collect()} == want
