"""N-gram Jaccard self-join with signature trees, exact, to connected components.

Two documents link when their sets of 5-word shingles have a Jaccard
similarity of at least 0.8 (``100 * common >= 80 * union``). Equal sets form
one class; classes are what is joined.

1. One pass gives each document its set size, class and token bitmap, and
   counts the frequent shingles (repeated inside a batch of documents). The
   ``FREQUENT`` most frequent are kept as an order, nothing else: they come
   last in the global order of shingles, so common passages hardly ever
   decide who is compared. Any fixed order is exact.
2. A second pass emits each document's prefix in that order
   (``n - ceil(0.8 n) + 1`` shingles): linked sets share a prefix shingle.
   Classes with a common prefix shingle form a group; groups with the same
   members are compared once. A frequent shingle's members are dealt to chunks
   of about ``CHUNK``, and every pair of chunks is compared.
3. In each group the classes, sorted by size, are the leaves of a signature
   tree: a node holds the OR of its bitmaps and its size range. A dual
   traversal drops node pairs whose largest possible overlap is too small for
   any pair below, and node pairs inside one candidate component. What is
   left yields a spanning forest of the pairs that the bitmaps cannot refute.
4. The components of these candidate edges get their shingle sets (read again
   for one document per class) and are traversed again, now with an exact
   check at the leaves. The components of the exact links are the result.
5. Where links are counted, the exact traversal skips only what the bounds
   refute: node pairs of at most ``BLOCK`` leaves are compared all with all by
   one matrix product, every pair of classes in one task only. A task returns
   its links as a sum per class and a spanning forest.

Without counts a group of near copies costs about one check per member, since
pairs inside a found component are skipped; with them it costs its true links,
but no list of all pairs is ever made. Chunks bound the memory of a task by
``CHUNK`` bitmaps or ``SET_BYTES`` of shingles.

Edge cases: a null or empty text, or one without words, has an empty set and
is linked with nothing; its component is itself. Repeated rows and equal texts
share a class. A null id never names a component while another id is in it.
Shingles are told apart by 64-bit hashes, classes by 64 bits over the set.
Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import small_batches, store, store_alone, utf8_buffers
from snapmart.llm.components import components
from snapmart.llm.shingles import distinct_sorted, mix, text_shingles

#: Similarity as a fraction NUMER / DENOM.
NUMER, DENOM = 80, 100
#: Frequent shingles that are ordered last (8 bytes each in every task).
FREQUENT = 1 << 16
#: Times a shingle must stand in one batch of documents to be counted.
LOCAL_FREQUENT = 3
#: Members of one chunk of a group.
CHUNK = 2048
#: Bytes of shingle sets of one chunk in the exact comparison.
SET_BYTES = 64 << 20
#: Bits of the filter that tells which documents' sets are wanted again; fixed,
#: so it can be sent to every task. Other documents it lets through cost time only.
FILTER_BITS = 1 << 24
FANOUT = 8
#: Leaves of a node that is compared as a whole when links are counted.
BLOCK = 64
#: Stands for a null id inside the join: larger than any other.
NO_ID = (1 << 63) - 1
MIN_BITS, MAX_BITS = 64, 1 << 16


# ---------------------------------------------------------------- signatures


def bitmap_width(n: int) -> int:
    """Bits of the bitmap of a set of ``n`` shingles: a power of two, one or two per shingle."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (n - 1).bit_length()))


def bitmap(hashes: np.ndarray) -> bytes:
    """Bitmap of a set; bit ``hash mod width``."""
    bits = np.zeros(bitmap_width(hashes.size), np.uint8)
    bits[(hashes & np.uint64(bits.size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def fold(bits: int, width: int, to: int) -> int:
    """The same set's bitmap at a smaller width."""
    while width > to:
        width >>= 1
        bits = (bits >> width) | (bits & ((1 << width) - 1))
    return bits


class Node:
    """OR of the bitmaps below, their size range, and the most shingles that share a bit."""

    __slots__ = ("bits", "children", "excess", "hi", "leaf", "lo", "one")

    def __init__(self, bits: int, lo: int, hi: int, excess: int, children: list[Node], leaf: int) -> None:
        self.bits, self.lo, self.hi, self.excess, self.children, self.leaf = bits, lo, hi, excess, children, leaf
        self.one = leaf >= 0  # known to lie inside one component


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def build(members: list[tuple[int, int, int]], width: int) -> Node:
    """Tree over ``(position, size, bits)`` at one width; leaves in order of size."""
    level = [Node(b, n, n, n - b.bit_count(), [], i) for i, n, b in sorted(members, key=lambda m: (m[1], m[2]))]
    while len(level) > 1:
        upper = []
        for at in range(0, len(level), FANOUT):
            some = level[at : at + FANOUT]
            bits = 0
            for c in some:
                bits |= c.bits
            upper.append(Node(bits, min(c.lo for c in some), max(c.hi for c in some), max(c.excess for c in some), some, -1))
        level = upper
    return level[0]


def possible(a: Node, b: Node) -> bool:
    """Whether any pair below ``a`` and ``b`` may have the overlap its sizes ask for."""
    if NUMER * max(a.lo, b.lo) > DENOM * min(a.hi, b.hi):
        return False
    most = min((a.bits & b.bits).bit_count() + min(a.excess, b.excess), a.hi, b.hi)
    # common / union >= NUMER / DENOM, with sizes no smaller than lo.
    return (NUMER + DENOM) * most >= NUMER * (a.lo + b.lo)


class DualTraversal:
    """Walks pairs of nodes; ``check`` decides the leaf pairs that are left."""

    def __init__(self, forest: Forest, check: Callable[[int, int], bool]) -> None:
        self.forest, self.check, self.links = forest, check, []

    def inside_one(self, node: Node) -> bool:
        """Whether all leaves below are in one component (once true, always true)."""
        if not node.one:
            if all(self.inside_one(c) for c in node.children):
                find = self.forest.find
                first = find(some_leaf(node.children[0]))
                node.one = all(find(some_leaf(c)) == first for c in node.children[1:])
        return node.one

    def within(self, node: Node) -> None:
        for i, c in enumerate(node.children):
            self.within(c)
            for d in node.children[:i]:
                self.between(d, c)

    def between(self, a: Node, b: Node) -> None:
        if not possible(a, b):
            return
        if self.inside_one(a) and self.inside_one(b) and self.forest.find(some_leaf(a)) == self.forest.find(some_leaf(b)):
            return
        if a.leaf >= 0 and b.leaf >= 0:
            if self.check(a.leaf, b.leaf):
                self.forest.join(a.leaf, b.leaf)
                self.links.append((a.leaf, b.leaf))
        elif b.leaf >= 0 or (a.leaf < 0 and a.hi - a.lo >= b.hi - b.lo):
            for c in a.children:
                self.between(c, b)
        else:
            for c in b.children:
                self.between(a, c)


class CountingTraversal(DualTraversal):
    """Counts every link of each member, weighted by the other's ``copies``; ``links`` is a spanning forest."""

    def __init__(self, sets: list[np.ndarray], copies: list[int]) -> None:
        super().__init__(Forest(len(sets)), lambda i, j: False)
        self.sets, self.copies = sets, np.array(copies, np.int64)
        self.counts = np.zeros(len(sets), np.int64)
        self.below: dict[Node, list[int]] = {}

    def leaves(self, node: Node) -> list[int]:
        """Leaves below; only short lists are kept."""
        if node.leaf >= 0:
            return [node.leaf]
        if node not in self.below:
            out = [i for c in node.children for i in self.leaves(c)]
            self.below[node] = out if len(out) <= BLOCK else []
        return self.below[node]

    def small(self, node: Node) -> list[int]:
        """The leaves below if they are one block, else nothing."""
        if node.leaf < 0 and any(not self.small(c) for c in node.children):
            return []
        return self.leaves(node)

    def within(self, node: Node) -> None:
        if some := self.small(node):
            self.compare(some, some)
        else:
            super().within(node)

    def between(self, a: Node, b: Node) -> None:
        if not possible(a, b):
            return
        ours, theirs = self.small(a), self.small(b)
        if ours and theirs:
            self.compare(ours, theirs)
        elif theirs or (not ours and a.hi - a.lo >= b.hi - b.lo):
            for c in a.children:
                self.between(c, b)
        else:
            for c in b.children:
                self.between(a, c)

    def compare(self, ours: list[int], theirs: list[int]) -> None:
        """All pairs of two blocks, or of one block with itself."""
        common = shared_counts([self.sets[i] for i in ours], [self.sets[j] for j in theirs])
        n, m = (np.array([self.sets[i].size for i in x], np.int64) for x in (ours, theirs))
        linked = DENOM * common >= NUMER * (n[:, None] + m - common)
        if ours is theirs:
            linked = np.triu(linked, 1)
        self.counts[ours] += linked @ self.copies[theirs]
        self.counts[theirs] += self.copies[ours] @ linked
        find = self.forest.find
        x, y = np.nonzero(linked)
        if x.size:
            # One link is enough for each pair of components.
            a, b = np.array([find(i) for i in ours])[x], np.array([find(j) for j in theirs])[y]
            for k in np.unique(np.where(a == b, -1, a * len(self.sets) + b), return_index=True)[1]:
                if self.forest.join(ours[x[k]], theirs[y[k]]):
                    self.links.append((ours[x[k]], theirs[y[k]]))


def shared_counts(ours: list[np.ndarray], theirs: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Number of common shingles of every pair of sets, by products of 0/1 matrices of ``width`` shingles."""
    every = [np.concatenate(x) for x in (ours, theirs)]
    keys = np.intersect1d(*every)
    sides = []
    for held, sets in zip(every, (ours, theirs), strict=True):
        owner = np.repeat(np.arange(len(sets)), [x.size for x in sets])
        at = np.searchsorted(keys, held)
        there = at < keys.size
        there[there] = keys[at[there]] == held[there]
        at, owner = at[there], owner[there]
        order = np.argsort(at, kind="stable")
        sides.append((at[order], owner[order]))
    out = np.zeros((len(ours), len(theirs)), np.int64)
    for low in range(0, keys.size, width):
        dense = []
        for (at, owner), sets in zip(sides, (ours, theirs), strict=True):
            i, j = np.searchsorted(at, (low, low + width))
            x = np.zeros((len(sets), min(width, keys.size - low)), np.float32)
            x[owner[i:j], at[i:j] - low] = 1.0
            dense.append(x)
        out += (dense[0] @ dense[1].T).astype(np.int64)
    return out


def some_leaf(node: Node) -> int:
    """Any leaf below."""
    while node.leaf < 0:
        node = node.children[0]
    return node.leaf


def traverse(sides: list[int], sizes: list[int], bitmaps: list[bytes], check: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """Spanning links among the members (``sides`` all 0) or between side 0 and side 1."""
    walk = DualTraversal(Forest(len(sizes)), check)
    walk_bands(walk, sides, sizes, bitmaps, any(sides))
    return walk.links


def walk_bands(walk: DualTraversal, sides: list[int], sizes: list[int], bitmaps: list[bytes], two: bool) -> None:
    """Meets every pair of members once, or of side 0 and side 1 if ``two``.

    Members of one bitmap width share a tree; a neighbouring width's tree is
    folded to the smaller one.
    """
    bands: dict[tuple[int, int], list] = {}
    for i, (side, n, raw) in enumerate(zip(sides, sizes, bitmaps, strict=True)):
        bands.setdefault((side, 8 * len(raw)), []).append((i, n, int.from_bytes(raw, "little")))
    trees = {k: build(m, k[1]) for k, m in bands.items()}
    for side, width in sorted(bands):
        for wide in (width, 2 * width):
            for other in (0, 1) if two else (0,):
                if two and side == other:
                    continue
                if wide == width and two and side > other:
                    continue
                if wide == width and not two:
                    walk.within(trees[side, width])
                elif (other, wide) in bands:
                    if wide == width:
                        walk.between(trees[side, width], trees[other, wide])
                    else:
                        folded = build([(i, n, fold(b, wide, width)) for i, n, b in bands[other, wide]], width)
                        walk.between(trees[side, width], folded)


# ---------------------------------------------------------------- Spark steps


def set_class(hashes: np.ndarray) -> int:
    """64-bit id of a non-empty set."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


_SETS = "kind int, doc_id bigint, n_shingles bigint, cls bigint, bits binary, shingle bigint, times bigint"


def document_sets(docs: DataFrame) -> DataFrame:
    """Kind 0: size, class and bitmap of each document; kind 1: local counts of frequent shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, at = text_shingles(*utf8_buffers(b.column(1)))
            sets = distinct_sorted(hashes, at)
            every = np.sort(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
            starts = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if every.size else np.zeros(0, np.int64)
            times = np.diff(np.append(starts, every.size))
            often = times >= LOCAL_FREQUENT
            n, m = len(sets), int(often.sum())
            none, nothing = [None] * m, [None] * n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([0] * n + [1] * m, pa.int32()),
                    pa.array(b.column(0).to_pylist() + none, pa.int64()),
                    pa.array([s.size for s in sets] + none, pa.int64()),
                    pa.array([set_class(s) if s.size else None for s in sets] + none, pa.int64()),
                    pa.array([bitmap(s) if s.size else None for s in sets] + none, pa.binary()),
                    pa.array(nothing + every[starts[often]].view(np.int64).tolist(), pa.int64()),
                    pa.array(nothing + times[often].tolist(), pa.int64()),
                ],
                [c.split()[0] for c in _SETS.split(", ")],
            )

    return docs.mapInArrow(run, _SETS)


def frequent_shingles(sets: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles and their counts, rarest first (at most ``most``)."""
    counted = sets.filter("kind = 1").groupBy("shingle").agg(F.sum("times").alias("times"))
    rows = counted.orderBy(F.desc("times"), "shingle").limit(most).collect()
    rows.reverse()
    return np.array([r[0] for r in rows], np.int64).view(np.uint64), np.array([r[1] for r in rows], np.int64)


def prefix(hashes: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The set's first shingles in the global order, enough to meet every linked set.

    ``common`` holds the frequent shingles sorted by value, ``rank`` their
    place in the order.
    """
    length = hashes.size - -(-NUMER * hashes.size // DENOM) + 1
    if not common.size:
        return hashes[:length]
    at = np.minimum(np.searchsorted(common, hashes), common.size - 1)
    is_common = common[at] == hashes
    out = hashes[~is_common][:length]
    if out.size < length:
        late = hashes[is_common]
        out = np.concatenate((out, late[np.argsort(rank[at[is_common]], kind="stable")][: length - out.size]))
    return out


_ENTRIES = "bucket bigint, shingle bigint, chunk int, chunks int, keys binary, classes binary"


def prefix_entries(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """Packed ``(shingle, class)`` entries of each batch, one row per bucket.

    A frequent shingle with more than ``CHUNK`` counted members has rows of
    its own, dealt to chunks by the class.
    """
    shingles, counts = frequent
    by_value = np.argsort(shingles, kind="stable")
    common = shingles[by_value]
    rank = by_value.astype(np.int64)
    chunks_of = {int(s): int(-(-c // CHUNK)) for s, c in zip(shingles, counts, strict=True) if c > CHUNK}
    hot = np.array(sorted(chunks_of), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, at = text_shingles(*utf8_buffers(b.column(0)))
            sets = [s for s in distinct_sorted(hashes, at) if s.size]
            rows = []
            if sets:
                classes = np.array([set_class(s) for s in sets], np.int64)
                heads = [prefix(s, common, rank) for s in sets]
                keys = np.concatenate(heads)
                owner = np.repeat(classes, [h.size for h in heads])
                is_hot = np.isin(keys, hot)
                for key in np.unique(keys[is_hot]):
                    own = np.unique(owner[keys == key])
                    n = chunks_of[int(key)]
                    deal = (mix(own.view(np.uint64)) % np.uint64(n)).astype(np.int64)
                    rows.extend((None, int(key.view(np.int64)), int(c), n, None, own[deal == c].tobytes()) for c in np.unique(deal))
                keys, owner = keys[~is_hot], owner[~is_hot]
                bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                keys, owner, bucket = keys[order], owner[order], bucket[order]
                cuts = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), bucket.size) if bucket.size else []
                rows.extend((int(bucket[i]), None, 0, 1, keys[i:j].tobytes(), owner[i:j].tobytes()) for i, j in zip(cuts[:-1], cuts[1:], strict=True))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in _ENTRIES.split(", ")])

    return docs.select("text").mapInArrow(run, _ENTRIES)


_MEMBERS = "grp bigint, chunk int, chunks int, cls bigint"


def groups_of_buckets(entries: DataFrame) -> DataFrame:
    """Members of every prefix shingle that two or more classes share, equal lists once."""
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = ["grp", "chunk", "chunks", "members"]

    def groups(keys: list[bytes], owners: list[bytes]) -> Iterator[tuple]:
        key = np.frombuffer(b"".join(keys), np.uint64)
        owner = np.frombuffer(b"".join(owners), np.int64)
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])))
        key, owner = key[new], owner[new]
        cuts = np.append(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))), key.size)
        for i in np.flatnonzero(np.diff(cuts) > 1):
            own = owner[cuts[i] : cuts[i + 1]]
            n = -(-own.size // CHUNK)
            grp = set_class(own.view(np.uint64))
            deal = (mix(own.view(np.uint64)) % np.uint64(n)).astype(np.int64)
            for c in range(n):
                yield grp, c, n, own[deal == c].tobytes()

    def batch(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, keys, owners = None, [], []
        for b in batches:
            for at, k, o in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if at != bucket:
                    if keys:
                        yield batch(list(groups(keys, owners)))
                    bucket, keys, owners = at, [], []
                keys.append(k)
                owners.append(o)
        if keys:
            yield batch(list(groups(keys, owners)))

    packed = entries.filter("bucket is not null").select("bucket", "keys", "classes").repartition("bucket").sortWithinPartitions("bucket")
    lists = packed.mapInArrow(run, "grp bigint, chunk int, chunks int, members binary").dropDuplicates(["grp", "chunk"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [np.frombuffer(m, np.int64) for m in b.column(3).to_pylist()]
            lengths = [x.size for x in lists]
            columns = [np.repeat(c.to_numpy(zero_copy_only=False), lengths) for c in b.columns[:3]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64))], ["grp", "chunk", "chunks", "cls"])

    hot = entries.filter("bucket is null").select(F.col("shingle").alias("grp"), "chunk", "chunks", F.col("classes").alias("members"))
    return lists.mapInArrow(unpack, _MEMBERS).unionByName(hot.mapInArrow(unpack, _MEMBERS).distinct())


def chunk_pairs(members: DataFrame) -> DataFrame:
    """Each member once for every pair of chunks its chunk is in (``one``, ``two``, ``side``)."""
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    out = members.select("*", other)
    return (
        out.withColumn("one", F.least("chunk", "other"))
        .withColumn("two", F.greatest("chunk", "other"))
        .withColumn("side", (F.col("chunk") > F.col("other")).cast("int"))
        .drop("other", "chunk", "chunks")
    )


def links_in_groups(rows: DataFrame, exact: bool, counted: bool = False) -> DataFrame:
    """``a, b`` links of every ``(grp, one, two)``; ``data`` is a bitmap, or the set if ``exact``.

    If ``counted``, rows with a null ``b`` hold in ``n`` the documents that
    link with those of class ``a`` in this task, by the ``copies`` of classes.
    """

    def linked(rows: list[tuple]) -> list[tuple]:
        rows = list({r[4]: r for r in rows}.values())  # a repeated row is the same class
        if len(rows) < 2:
            return []
        classes = [r[4] for r in rows]
        sets = [np.frombuffer(r[6], np.uint64) for r in rows] if exact else []
        maps = [bitmap(s) for s in sets] if exact else [r[6] for r in rows]

        def check(i: int, j: int) -> bool:
            if not exact:
                return True
            common = np.intersect1d(sets[i], sets[j], assume_unique=True).size
            return DENOM * common >= NUMER * (sets[i].size + sets[j].size - common)

        sides, sizes = [r[3] for r in rows], [r[5] for r in rows]
        if counted:
            walk = CountingTraversal(sets, [r[7] for r in rows])
            walk_bands(walk, sides, sizes, maps, rows[0][1] != rows[0][2])
            sums = [(classes[i], None, int(walk.counts[i])) for i in np.flatnonzero(walk.counts)]
            return [(classes[i], classes[j], None) for i, j in walk.links] + sums
        return [(classes[i], classes[j]) for i, j in traverse(sides, sizes, maps, check)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for b in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[:3] != group:
                    out.extend(linked(held))
                    group, held = row[:3], []
                held.append(row)
            yield edges(out)
        yield edges(linked(held))

    def edges(found: list) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["a", "b"] + ["n"] * counted
    dealt = rows.select("grp", "one", "two", "side", "cls", "n_shingles", "data", *["copies"] * counted).repartition("grp", "one", "two")
    return dealt.sortWithinPartitions("grp", "one", "two").mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def jaccard_components(docs: DataFrame, counted: bool = True) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id`` of every document; if ``counted``, ``n_links`` too.

    ``n_links`` is the number of other rows a row is linked with, those with
    an equal set among them.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"), "text")
    both = store(document_sets(docs), "sets")
    sets = both.filter("kind = 0").select("doc_id", "n_shingles", "cls", "bits")
    frequent = frequent_shingles(both)
    # About 0.2 prefix entries a shingle; a bucket holds some 200,000 of them.
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    entries = store(prefix_entries(docs, frequent, buckets=1 + total // 1_000_000), "prefixes")
    members = store(groups_of_buckets(entries), "groups")

    # One document stands for each class.
    first = sets.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies"))
    active = members.select("cls").distinct()
    infos = sets.join(first.select("cls", "doc_id"), ["cls", "doc_id"], "left_semi").join(active, "cls", "left_semi").dropDuplicates(["cls"])
    with_bits = chunk_pairs(members).join(infos.select("cls", "n_shingles", F.col("bits").alias("data")), "cls")
    maybe = store(links_in_groups(with_bits, exact=False).distinct(), "candidates")
    candidates = components(maybe)

    # Classes that have a candidate, with their chunk in the candidate component.
    chosen = candidates.join(first, F.col("node") == F.col("cls")).select("doc_id", "cls", "n", "copies", F.col("label").alias("grp"))
    held = chosen.groupBy("grp").agg(F.sum("n").alias("held"), F.count(F.lit(1)).alias("rows"))
    chunks = F.greatest(F.ceil(F.col("rows") / F.lit(CHUNK)), F.ceil(F.col("held") * 8 / F.lit(SET_BYTES))).cast("int")
    chosen = chosen.join(held.select("grp", chunks.alias("chunks")), "grp").drop("n")
    chosen = store(chosen.withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int")), "chosen")
    exact_rows = class_sets(docs, wanted_filter(chosen)).join(chosen, ["doc_id", "cls"]).drop("doc_id")
    links = store(links_in_groups(chunk_pairs(exact_rows), exact=True, counted=counted), "links")
    joined = components(links)

    out = name_components(sets, first, joined)
    if not counted:
        return out
    sums = links.filter("b is null").groupBy(F.col("a").alias("_class")).agg(F.sum("n").alias("others"))
    own = first.join(sums, F.col("cls") == F.col("_class"), "left")
    own = own.select(F.col("cls").alias("_cls"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = out.join(own, F.col("class_id") == F.col("_cls"), "left").drop("_cls")
    return out.withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("bigint")))


def filter_bit(doc_id: Column) -> Column:
    """The filter bit of a document id."""
    return F.pmod(F.xxhash64(doc_id), F.lit(FILTER_BITS).cast("bigint"))


def wanted_filter(chosen: DataFrame) -> np.ndarray:
    """``FILTER_BITS`` bits, set for the chosen documents (at most one row per 64 bits is collected)."""
    bit = filter_bit(F.col("doc_id"))
    words = chosen.select(F.floor(bit / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int")).alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[[r.word for r in rows]] = [r.bits for r in rows]
    return out


def class_sets(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """``doc_id, cls, n_shingles, data`` with the shingle set of each document the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bit = b.column(2).to_numpy(zero_copy_only=False)
            b = b.filter(pa.array((wanted[bit >> 6] >> (bit & 63)) & 1 == 1))
            sets = distinct_sorted(*text_shingles(*utf8_buffers(b.column(1))))
            keep = [i for i, s in enumerate(sets) if s.size]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(keep, pa.int64())),
                    pa.array([set_class(sets[i]) for i in keep], pa.int64()),
                    pa.array([sets[i].size for i in keep], pa.int64()),
                    pa.array([sets[i].tobytes() for i in keep], pa.binary()),
                ],
                ["doc_id", "cls", "n_shingles", "data"],
            )

    rows = docs.select("doc_id", "text", filter_bit(F.col("doc_id")).alias("bit"))
    return rows.mapInArrow(run, "doc_id bigint, cls bigint, n_shingles bigint, data binary")


def name_components(sets: DataFrame, first: DataFrame, joined: DataFrame) -> DataFrame:
    """Each document with the smallest id of its component."""
    labelled = first.join(joined, F.col("cls") == F.col("node"), "left")
    labelled = labelled.select("cls", "doc_id", F.coalesce("label", "cls").alias("label"))
    names = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_class = labelled.join(names, "label").select("cls", "component_id")
    out = sets.join(by_class, "cls", "left")
    ids = [F.nullif(c, F.lit(NO_ID)) for c in (F.col("doc_id"), F.coalesce("component_id", "doc_id"))]
    return out.select(ids[0].alias("doc_id"), "n_shingles", ids[1].alias("component_id"), F.col("cls").alias("class_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id; columns unchanged.

    Repeats of that row stay once. Rows without an id cannot be told apart by
    it; where only such rows are in a component, each different text stays.
    """
    found = store_alone(docs.sparkSession, lambda: jaccard_components(docs, counted=False), "components")
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept"))
    wanted = kept.distinct()
    out = docs.join(wanted, docs["doc_id"].cast("bigint").eqNullSafe(wanted["_kept"]), "left_semi")
    if kept.groupBy("_kept").count().filter("count > 1").isEmpty():
        return out
    return out.dropDuplicates(["doc_id", "text"])
