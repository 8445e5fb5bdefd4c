"""Mixture-controlled packing of token ids by deficit round-robin.

Every text is tokenized once (ids by the given vocabulary, then one end id)
and stored. Each source is a queue whose documents stand in the order of a
hash, and the queues are served in proportion to their targets: the tokens
before a document in its queue, over the queue's target share, are its virtual
time, and documents are handed out by virtual time. A queue that runs out
leaves its share to the others. Parts of about ``PART_TOKENS`` tokens are cut
from that order. It is found from counts alone: each queue is divided by hash
into buckets (of a sixteenth of a part, but at most ``MAX_BUCKETS`` and one per
source in all), running sums over the buckets give their virtual times and the
tokens handed out before them, and inside a bucket documents are spread evenly.

Parts run in parallel. In each one, every window of ``WINDOW`` tokens adds its
target share to the deficit of every queue; the queue with the largest deficit
is served next, with at least ``MIN_PIECE`` tokens or what is left of its
document or the window. What a queue got too much or too little stays in its
deficit for the next window. A part hands out all its tokens, so the deficits
it closes with follow from its counts; a running sum over the parts gives each
part the whole deficits it opens with, and it makes up for them evenly over its
windows. Running sums have two levels, so no task sees one row per part.

Targets default to each source's share of all tokens. With other targets the
windows keep to them until a queue has run out. Sources without a target come
last. Windows are full but for the last of each part.

Edge cases: a null or empty text is the end id alone; a null source is a
source; repeated rows are packed each; an empty table gives an empty result.
Extra columns are not read.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator, Mapping
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import small_batches, store

WINDOW = 2048
MIN_PIECE = 256
PART_TOKENS = 1 << 21
#: Rows that one task adds up in a running sum, about.
SPAN = 1024
#: Buckets that the queues are divided into at most, besides one per source.
MAX_BUCKETS = 1 << 16
#: Words whose ids a worker remembers at most; half of them are words met again.
CACHE_WORDS = 500_000
#: Code points that are tokenized at once.
CHUNK_CHARS = 1 << 22


class WordTokenizer:
    """Ids of whole texts, one lookup per distinct word of many texts.

    For vocabularies that lower-case and compose texts, cut them by a pattern
    that never joins what white space parts, and mark the end of each cut: the
    ids of a text are then those of its words in order, and a word's are those
    of its cuts. The unknown words of many texts are cut together, and their
    unknown cuts are encoded in one call with white space between them and
    parted again after each end mark. Words with signs that other engines may
    cut differently (not printable or not composed) go one by one through the whole
    tokenizer.

    Special tokens in a text get their ids, as the tokenizer does it; such a
    text is encoded as it stands. ``special_as_text`` makes them plain text.

    Memory holds ``CACHE_WORDS`` words: when it is full, the words that were
    met in more than one call stay (half of the memory at most) and the others go.
    """

    def __init__(self, path: str, end_id: int, special_as_text: bool = False) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [] if special_as_text else added
        rules = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"]
        self.cuts = regex.compile(rules[0]["pattern"]["Regex"] + "|\n")
        self.joined = Tokenizer(self.tokenizer.model)
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.joined.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), level])
        self.end = np.array([end_id], "<u4").tobytes()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.young: set[str] = set()
        self.common: set[str] = {""}

    def _one_by_one(self, words: list[str]) -> None:
        for w, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self.known[w] = np.array(e.ids, "<u4").tobytes()

    def _encode_cuts(self, cuts: list[str]) -> None:
        for at in range(0, len(cuts), 4096):
            some = cuts[at : at + 4096]
            ids = np.array(self.joined.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(some):
                self._one_by_one(some)
                continue
            raw, cut = ids.tobytes(), [0, *(4 * ends).tolist()]
            self.known.update((w, raw[i:j]) for w, i, j in zip(some, cut, cut[1:], strict=False))

    def _learn(self, words: list[str]) -> None:
        """Put the ids of unknown ``words`` and of their cuts into memory."""
        odd = [w for w in words if not w.isprintable()]
        if odd or not unicodedata.is_normalized("NFC", "\n".join(words)):
            odd = [w for w in words if not w.isprintable() or not unicodedata.is_normalized("NFC", w)]
            self._one_by_one(odd)
            words = [w for w in words if w not in self.known]
        whole = [w for w in words if w.isalpha()]
        mixed = [w for w in words if not w.isalpha()]
        found = self.cuts.findall("\n".join(mixed))
        known = self.known
        self._encode_cuts(list({*whole, *(c for c in found if c != "\n" and c not in known)}))
        cuts: list[bytes] = []
        at = iter(mixed)
        for c in found:
            if c == "\n":
                known[next(at)] = b"".join(cuts)
                cuts = []
            else:
                cuts.append(known[c])
        for w in at:
            known[w] = b"".join(cuts)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text and the end id."""
        # The tokenizer lower-cases letter by letter: a final sigma is none to it.
        # Texts are split at ASCII white space only, which is white space to it too.
        marked = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        lower = pa.array([t.replace("\u03a3", "\u03c3").lower() for t in texts], pa.large_string())
        split = pc.ascii_split_whitespace(lower)
        coded = split.flatten().dictionary_encode()
        # Words hold no line feed, so one text of all of them is cut quickly.
        one_list = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        joined = pc.binary_join(one_list, pa.scalar("\n", pa.large_string()))[0].as_py()
        words = joined.split("\n") if len(coded.dictionary) else []
        again = self.young.intersection(words)
        self.young -= again
        self.common.update(islice(again, max(0, CACHE_WORDS // 2 - len(self.common))))
        fresh = [w for w in words if w not in self.known]
        if len(self.known) + len(fresh) > CACHE_WORDS:
            self.known, self.young = {w: self.known[w] for w in self.common}, set()
            fresh = [w for w in words if w not in self.known]
        self._learn(fresh)
        self.young.update(fresh)
        ids = [self.known[w] for w in words]
        length = np.array([len(x) for x in ids], np.int64) // 4
        start, table = np.cumsum(length) - length, np.frombuffer(b"".join(ids), "<u4")
        index = coded.indices.to_numpy()
        n = length[index]
        ends = np.cumsum(n)
        # Id k of a word stands k places behind the word's first id.
        where = np.arange(ends[-1] if ends.size else 0) + np.repeat(start[index] - (ends - n), n)
        raw = table[where].tobytes()
        first = np.asarray(split.offsets)
        at = (4 * np.concatenate(([0], ends))[first - first[0]]).tolist()
        out = [raw[a:b] + self.end for a, b in zip(at, at[1:], strict=False)]
        for i in marked:
            out[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes() + self.end
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]


@cache
def word_tokenizer(path: str, end_id: int, special_as_text: bool) -> WordTokenizer:
    """One tokenizer per worker process, which keeps what it knows between tasks."""
    return WordTokenizer(path, end_id, special_as_text)


def chunks(texts: list[str], chars: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Runs of texts of at most ``chars`` code points, or of one text."""
    begin = total = 0
    for i, t in enumerate(texts):
        if i > begin and total + len(t) > chars:
            yield texts[begin:i]
            begin, total = i, 0
        total += len(t)
    if begin < len(texts):
        yield texts[begin:]


def squeeze(ids: bytes, compressor: zstandard.ZstdCompressor) -> bytes:
    """Ids as compressed 16- or 32-bit numbers; the first byte says which."""
    numbers = np.frombuffer(ids, "<u4")
    if numbers.max(initial=0) < 1 << 16:
        return b"\x02" + compressor.compress(numbers.astype("<u2").tobytes())
    return b"\x04" + compressor.compress(ids)


def unsqueeze(raw: bytes, decompressor: zstandard.ZstdDecompressor) -> bytes:
    """The 32-bit ids of :func:`squeeze`."""
    ids = decompressor.decompress(raw[1:])
    return ids if raw[0] == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, special_as_text: bool = False, squeezed: bool = False) -> DataFrame:
    """``doc_id, source, n_tokens, ids`` (binary, little-endian unsigned 32 bit) of every whole text.

    ``squeezed`` ids are those of :func:`squeeze`.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer_path, end_id, special_as_text)
        compressor = zstandard.ZstdCompressor()
        for b in batches:
            texts = [t or "" for t in b.column(2).to_pylist()]
            ids = [x for some in chunks(texts) for x in words.encode_many(some)]
            n = pa.array([len(x) // 4 for x in ids], pa.int64())
            if squeezed:
                ids = [squeeze(x, compressor) for x in ids]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n, pa.array(ids, pa.binary())], ["doc_id", "source", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, source string, n_tokens bigint, ids binary"
    )


def fill_windows(queues: dict, opening: dict, share: dict, window: int = WINDOW, min_piece: int = MIN_PIECE) -> Iterator[tuple]:
    """Deficit round-robin over one part.

    ``queues``: per source its documents as a list of ``(doc_id, ids)``.
    Yields ``(doc_id, start, piece, doc_tokens, window_number, offset)``. Each
    window adds every open queue's part of the target shares to its deficit; the
    whole opening deficits are added in equal parts over the windows.
    """
    left = {s: sum(len(ids) for _, ids in q) // 4 for s, q in queues.items()}
    total = sum(left.values())
    windows = max(1, -(-total // window))
    debt = dict.fromkeys(left, 0.0)
    at = dict.fromkeys(left, (0, 0))
    number = 0
    while total:
        room = min(window, total)
        offset = 0
        all_shares = sum(share.get(s, 0.0) for s in left)
        for s in debt:
            part = share.get(s, 0.0) / all_shares if all_shares > 0 else left[s] / total
            debt[s] += window * part + opening.get(s, 0.0) / windows
        while room:
            s = max(left, key=debt.__getitem__)
            k, start = at[s]
            doc_id, ids = queues[s][k]
            size = len(ids) // 4
            take = min(room, size - start, max(min_piece, int(debt[s])))
            yield doc_id, start, ids[4 * start : 4 * (start + take)], size, number, offset
            at[s] = (k + 1, 0) if start + take == size else (k, start + take)
            debt[s] -= take
            left[s] -= take
            if not left[s]:
                del left[s], debt[s]
            room -= take
            offset += take
            total -= take
        number += 1


def running_before(rows: DataFrame, value: str, order: str, by: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``, the sum of ``value`` over the rows of smaller ``order``.

    ``order`` holds whole numbers, once in each group of ``by``. Sums over spans
    of ``SPAN`` numbers are added up first, then the rows inside a span.
    """
    span = rows.withColumn("_span", F.floor(F.col(order) / F.lit(SPAN)))
    spans = span.groupBy(*by, "_span").agg(F.sum(value).alias("_sum"))
    ahead = Window.partitionBy(*by).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    spans = spans.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_span").alias("_of"), F.coalesce(F.sum("_sum").over(ahead), zero).alias("_ahead"))
    inside = Window.partitionBy(*by, "_span").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = span.withColumn(name, F.coalesce(F.sum(value).over(inside), zero))
    same = F.col("_span") == F.col("_of")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return out.join(spans, same).withColumn(name, F.col(name) + F.col("_ahead")).drop("_span", "_of", "_ahead", *[f"_{c}" for c in by])


def source_queues(tokens: DataFrame, part_tokens: int, targets: Mapping[str | None, float] | None) -> DataFrame:
    """``_source, share, n_buckets, width``: one row per source; ``width`` is the tokens of a bucket, about."""
    held = tokens.groupBy(F.col("source").alias("_source")).agg(F.sum("n_tokens").alias("held"))
    every = held.agg(F.sum("held").alias("total")).scalar()
    if targets is None:
        held = held.withColumn("share", F.col("held") / every)
    else:
        wanted = tokens.sparkSession.createDataFrame(list(targets.items()), "_target string, share double")
        held = held.join(wanted, F.col("_source").eqNullSafe(F.col("_target")), "left").drop("_target")
        held = held.withColumn("share", F.greatest(F.coalesce("share", F.lit(0.0)), F.lit(0.0)))
    width = F.greatest(F.lit(max(1, part_tokens // 16)).cast("bigint"), F.floor(every / F.lit(MAX_BUCKETS)))
    return held.select("_source", "share", F.ceil(F.col("held") / width).alias("n_buckets"))


def deal_to_parts(tokens: DataFrame, part_tokens: int, targets: Mapping[str | None, float] | None) -> tuple[DataFrame, DataFrame]:
    """``tokens`` with ``part``, and the queues (see :func:`source_queues`)."""
    queues = store(source_queues(tokens, part_tokens, targets), "pack-sources")
    keyed = tokens.join(queues, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    place = F.xxhash64("doc_id", "n_tokens")
    keyed = keyed.withColumn("bucket", F.pmod(place, F.col("n_buckets")))
    held = keyed.groupBy("source", "bucket", "share").agg(F.sum("n_tokens").alias("held"))
    held = running_before(held, "held", "bucket", ["source"], "ahead")
    # Queues without a share wait until all others are done. One row per bucket.
    time = F.when(F.col("share") > 0, F.col("ahead") / F.col("share"))
    order = Window.orderBy(time.asc_nulls_last(), F.col("source").asc_nulls_last(), "bucket").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("held").over(order), F.lit(0))
    buckets = store(held.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), begin.alias("begin"), "held"), "pack-buckets")
    inside = F.pmod(F.xxhash64(place, F.lit(1)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    part = F.floor((F.col("begin") + inside * F.col("held")) / F.lit(part_tokens)).alias("part")
    dealt = keyed.join(buckets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
    return dealt.select(*tokens.columns, part), queues


def part_headers(dealt: DataFrame, queues: DataFrame, window: int = WINDOW) -> DataFrame:
    """``part, source, opening, share, first_sequence`` from the counts of all parts."""
    counts = store(dealt.groupBy("part", "source").agg(F.sum("n_tokens").alias("held")), "pack-counts")
    shares = queues.select("_source", "share")
    counts = counts.join(shares, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    totals = counts.groupBy("part").agg(F.sum("held").alias("part_tokens"), F.sum("share").alias("part_share"))
    totals = totals.withColumn("windows", F.ceil(F.col("part_tokens") / F.lit(window)))
    totals = running_before(totals, "windows", "part", [], "first_sequence").withColumnRenamed("part", "_part")
    rows = counts.join(totals, F.col("part") == F.col("_part")).drop("_part")
    due = F.when(F.col("part_share") > 0, F.col("part_tokens") * F.col("share") / F.col("part_share")).otherwise(F.col("held").cast("double"))
    rows = running_before(rows.withColumn("owed", due - F.col("held")), "owed", "part", ["source"], "opening")
    return rows.select("part", "source", F.col("opening").cast("double").alias("opening"), "share", F.col("first_sequence").cast("bigint").alias("first_sequence"))


_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    window: int = WINDOW,
    part_tokens: int = PART_TOKENS,
    targets: Mapping[str | None, float] | None = None,
    with_ids: bool = False,
    special_as_text: bool = False,
) -> DataFrame:
    """Pieces of every document and their place in the sequences.

    ``with_ids`` adds the piece's ids (``ids``, binary) as training input.
    """
    tokens = store(tokenize(docs, tokenizer_path, end_id, special_as_text, squeezed=True), "pack-tokens")
    tokens, queues = deal_to_parts(tokens, part_tokens, targets)
    headers = part_headers(tokens.drop("ids"), queues, window)
    nothing = F.lit(None)
    rows = headers.select("part", F.lit(0).alias("kind"), "source", "opening", "share", "first_sequence", nothing.cast("bigint").alias("doc_id"), nothing.cast("binary").alias("ids"))
    rows = rows.unionByName(
        tokens.select("part", F.lit(1).alias("kind"), "source", F.lit(0.0).alias("opening"), F.lit(0.0).alias("share"), F.lit(0).cast("bigint").alias("first_sequence"), "doc_id", "ids")
    )
    names = [c.split()[0] for c in _PIECES.split(", ")] + ["ids"] * with_ids

    def batch(pieces: list) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in zip(*[p[:7] for p in pieces], strict=True)] or [pa.array([], pa.int64())] * 7
        if with_ids:
            columns.append(pa.array([p[7] for p in pieces], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names)

    def packed(queues: dict, opening: dict, share: dict, first: int) -> Iterator[pa.RecordBatch]:
        pieces = []
        for doc_id, start, ids, size, number, offset in fill_windows(queues, opening, share, window):
            pieces.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), size, first + number, offset, ids))
            if len(pieces) >= 10_000:
                yield batch(pieces)
                pieces = []
        yield batch(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, queues, opening, share = None, 0, {}, {}, {}
        decompressor = zstandard.ZstdDecompressor()
        for b in batches:
            for p, kind, source, o, sh, f, doc_id, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if p != part:
                    yield from packed(queues, opening, share, first)
                    part, first, queues, opening, share = p, 0, {}, {}, {}
                if kind == 0:
                    opening[source], share[source], first = o, sh, f
                else:
                    queues.setdefault(source, []).append((doc_id, unsqueeze(ids, decompressor)))
        yield from packed(queues, opening, share, first)

    # Inside a queue documents stand in the order of their hash.
    order = ["part", "kind", F.col("source").asc_nulls_last(), F.xxhash64("doc_id"), "doc_id", "ids"]
    dealt = rows.repartition("part").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, _PIECES + ", ids binary" * with_ids)
