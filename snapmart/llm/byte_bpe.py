"""Byte-level BPE over a corpus by a shuffle of its distinct words.

Encoding runs in three steps. (1) Every whole text is cut into pre-tokens by
the vocabulary's pattern. A task gathers texts into blocks of ``BLOCK_CHARS``
code points; a block numbers its distinct pre-tokens ("words") in the order
they first occur, and its texts become sequences of these numbers, so a word's
positions are stored once and never shuffled by word. (2) The distinct words of all
blocks are dealt by hash to ``BUCKETS`` buckets and meet there: each word is
encoded once, and its ids go back to every block that asked. (3) A block's
sequences, which stay where they were stored, meet the ids and are put together
by position.

A row of the word shuffle holds all words of one block and bucket, packed and
compressed, so a word that every block holds is one entry per block. Above
``GROUP`` reading tasks the buckets are salted by the group of the task: then a
word is encoded once per group, and no task gathers the requests of more.

Decoding flattens the ids of a batch of texts, joins them with the token-byte
table (as many rows as the vocabulary; each worker holds it) and puts the
bytes together by position.

Memory is bounded by a block and by ``WORD_MEMORY`` encoded words of a task (a
word that was put out is encoded again).

Edge cases: a null or empty text has no ids and decodes to empty bytes;
special tokens do not exist, so their names in a text are plain text; repeated
rows and null ids are kept; a text longer than a block is a block of its own;
an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from snapmart.llm.common import small_batches, store_by

#: A block ends when its texts have so many code points.
BLOCK_CHARS = 1 << 25
#: ... or so many distinct words.
BLOCK_WORDS = 1 << 20
BUCKETS = 256
#: Reading tasks whose words meet in the same buckets.
GROUP = 512
#: Code points that are cut at once.
CHUNK_CHARS = 1 << 21
#: Encoded words that a task remembers at most.
WORD_MEMORY = 1 << 18
_PART_BLOCKS = 1 << 24
_PARTS = "block bigint, kind int, bucket int, seq int, doc_ids array<bigint>, sizes array<int>, body binary"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank, from a file of base64 tokens and numbers."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PieceEncoder:
    """Ids of single pre-tokens."""

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        self.encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})
        # The pre-token is cut already, so it is merged as it stands.
        self.merge = self.encoding._encode_single_piece
        self.known: dict[bytes, bytes] = {}

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word; a word met before is not encoded again."""
        known = self.known
        if len(known) > WORD_MEMORY:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = np.array(self.merge(w), "<u4").tobytes()
        return [known[w] for w in words]


class TokenBytes:
    """The token-byte table as one buffer with offsets."""

    def __init__(self, path: str) -> None:
        ranks = load_ranks(path)
        size = max(ranks.values(), default=-1) + 1
        table = [b""] * size
        for token, rank in ranks.items():
            table[rank] = token
        self.tokens = pa.array(table, pa.binary())
        self.lengths = np.array([len(t) for t in table], np.int64)

    def join(self, ids: np.ndarray, first: np.ndarray) -> pa.Array:
        """Bytes of each row; row ``i`` has the ids from ``first[i]`` to ``first[i + 1]``."""
        taken = self.tokens.take(pa.array(ids, pa.int64()))
        ends = np.concatenate(([0], np.cumsum(self.lengths[ids])))[first]
        return pa.Array.from_buffers(pa.large_binary(), first.size - 1, [None, pa.py_buffer(ends.astype(np.int64).tobytes()), taken.buffers()[2]])


@cache
def _encoder(path: str, pattern: str) -> PieceEncoder:
    return PieceEncoder(path, pattern)


@cache
def _token_bytes(path: str) -> TokenBytes:
    return TokenBytes(path)


def pack_numbers(x: np.ndarray) -> bytes:
    """32-bit numbers as four byte planes, which compress well when most are small."""
    return zstandard.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def unpack_numbers(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_pieces(codes: np.ndarray, pieces: list[bytes]) -> bytes:
    """Byte strings and their numbers; the parts follow their sizes."""
    parts = [pack_numbers(codes), pack_numbers(np.array([len(p) for p in pieces], np.int64)), zstandard.compress(b"".join(pieces), 3)]
    return np.array([len(p) for p in parts], "<u4").tobytes() + b"".join(parts)


def unpack_pieces(raw: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Numbers, ends of the byte strings, and their bytes."""
    at = 12 + np.concatenate(([0], np.cumsum(np.frombuffer(raw[:12], "<u4").astype(np.int64))))
    codes, lengths = (unpack_numbers(raw[at[i] : at[i + 1]]) for i in (0, 1))
    return codes, np.cumsum(lengths.astype(np.int64)), zstandard.decompress(raw[at[2] :])


class Block:
    """Texts as sequences of numbers of the block's words."""

    def __init__(self, number: int) -> None:
        self.number, self.seq, self.chars = number, 0, 0
        self.codes: defaultdict[str, int] = defaultdict()
        self.codes.default_factory = self.codes.__len__

    def add(self, pattern: regex.Pattern, doc_ids: list, texts: list[str | None]) -> tuple:
        found = [pattern.findall(t) if t else [] for t in texts]
        sizes = [len(f) for f in found]
        code = self.codes.__getitem__
        numbers = np.fromiter(map(code, chain.from_iterable(found)), np.uint32, sum(sizes))
        self.chars += sum(len(t) for t in texts if t)
        self.seq += 1
        return self.number, 1, None, self.seq, doc_ids, sizes, pack_numbers(numbers)

    def words(self) -> Iterator[tuple]:
        """The block's words, one row for each bucket."""
        held: dict[int, tuple[list[int], list[bytes]]] = {}
        for word, code in self.codes.items():
            raw = word.encode()
            codes, words = held.setdefault(zlib.crc32(raw) % BUCKETS, ([], []))
            codes.append(code)
            words.append(raw)
        for bucket, (codes, words) in held.items():
            yield self.number, 0, bucket, 0, None, None, pack_pieces(np.array(codes, np.int64), words)


def chunks(doc_ids: list, texts: list[str | None], chars: int = CHUNK_CHARS) -> Iterator[tuple[list, list]]:
    """Runs of rows of at most ``chars`` code points, or of one row."""
    begin = total = 0
    for i, t in enumerate(texts):
        size = len(t or "")
        if i > begin and total + size > chars:
            yield doc_ids[begin:i], texts[begin:i]
            begin, total = i, 0
        total += size
    if begin < len(texts):
        yield doc_ids[begin:], texts[begin:]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_SCHEMA = pa.schema(
    [("block", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("body", pa.binary())]
)


def cut_into_words(docs: DataFrame, pattern: str) -> DataFrame:
    """Rows of kind 1 (texts of a block as word numbers) and kind 0 (the block's words of one bucket)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        number = TaskContext.get().partitionId() * _PART_BLOCKS
        block = Block(number)
        for b in batches:
            for doc_ids, texts in chunks(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield _batch([block.add(compiled, doc_ids, texts)], _SCHEMA)
                if block.chars >= BLOCK_CHARS or len(block.codes) >= BLOCK_WORDS:
                    yield from (_batch([row], _SCHEMA) for row in block.words())
                    number += 1
                    block = Block(number)
        yield from (_batch([row], _SCHEMA) for row in block.words())

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, _PARTS)


def encode_words(words: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of kind 0 with ids in place of words: each bucket's distinct words are encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for b in batches:
            bodies = []
            for raw in b.column(1).to_pylist():
                codes, ends, blob = unpack_pieces(raw)
                starts = [0, *ends.tolist()]
                bodies.append(pack_pieces(codes, encoder.encode([blob[a:z] for a, z in zip(starts, starts[1:], strict=False)])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bodies, pa.binary())], ["block", "body"])

    group = F.floor(F.col("block") / F.lit(_PART_BLOCKS * GROUP))
    dealt = words.withColumn("grp", group).repartition("bucket", "grp").select("block", "body")
    return dealt.mapInArrow(run, "block bigint, body binary")


class BlockIds:
    """Ids of a block's words by their numbers."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.table: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def add(self, raw: bytes) -> None:
        codes, ends, blob = unpack_pieces(raw)
        self.parts.append((codes.astype(np.int64), ends // 4, np.frombuffer(blob, "<u4")))

    def assemble(self, numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence of word numbers, and the end of each text's ids."""
        if self.table is None:
            n = sum(p[0].size for p in self.parts)
            start, length, before, flat = np.zeros(n, np.int64), np.zeros(n, np.int64), 0, []
            for codes, ends, ids in self.parts:
                begin = np.concatenate(([0], ends[:-1]))[: codes.size]
                start[codes], length[codes] = before + begin, ends - begin
                before += ids.size
                flat.append(ids)
            self.table = start, length, np.concatenate([*flat, np.zeros(0, np.uint32)])
            self.parts = []
        start, length, flat = self.table
        n = length[numbers]
        ends = np.cumsum(n)
        # Id k of a word stands k places behind the word's first id.
        where = np.arange(ends[-1] if ends.size else 0) + np.repeat(start[numbers] - (ends - n), n)
        return flat[where].astype("<u4"), np.concatenate(([0], ends))[np.cumsum(sizes)]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (binary, little-endian unsigned 32 bit) of every whole text."""
    # Kept by block, so that only the ids of the words travel to their block.
    cut = store_by(cut_into_words(docs, pattern), "bpe-words", "block")
    encoded = encode_words(cut.filter("kind = 0").select("block", "bucket", "body"), path, pattern)
    texts = cut.filter("kind = 1").select("block", "doc_ids", "sizes", "body")

    def assemble(sequences: pa.Table, words: pa.Table) -> pa.Table:
        ids = BlockIds()
        for body in words.column("body").to_pylist():
            ids.add(body)
        parts = []
        for doc_ids, sizes, body in zip(*(sequences.column(c) for c in ("doc_ids", "sizes", "body")), strict=True):
            flat, ends = ids.assemble(unpack_numbers(body.as_py()), sizes.values.to_numpy().astype(np.int64))
            at = np.concatenate(([0], ends)).astype(np.int64)
            values = pa.Array.from_buffers(pa.large_binary(), at.size - 1, [None, pa.py_buffer((4 * at).tobytes()), pa.py_buffer(flat.tobytes())])
            parts.append(pa.table([doc_ids.values, pa.array(np.diff(at)), values.cast(pa.binary())], names=["doc_id", "n_tokens", "ids"]))
        nothing = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]).empty_table()
        return pa.concat_tables([nothing, *parts])

    dealt = texts.groupBy("block").cogroup(encoded.groupBy("block"))
    return dealt.applyInArrow(assemble, "doc_id bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (a column ``ids`` as of :func:`encode`) with ``decoded``, the bytes of each row."""
    names = encoded.columns
    at = names.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_bytes(path)
        for b in batches:
            raw = [x or b"" for x in b.column(at).to_pylist()]
            first = np.concatenate(([0], np.cumsum([len(x) // 4 for x in raw]))).astype(np.int64)
            decoded = table.join(np.frombuffer(b"".join(raw), "<u4").astype(np.int64), first).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, decoded], [*names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", BinaryType())]))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text."""
    back = decode(encode(docs, path, pattern), path)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
