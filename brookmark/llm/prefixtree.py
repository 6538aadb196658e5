"""Jaccard join of word n-gram sets with prefix trees, exact and without pairs of copies.

1. A scan gives every document its set's size and digest, so that equal sets become one node; another
   finds the n-grams that many documents share.
2. Those n-grams go last in the one order that all sets are sorted by. A third scan emits each node's
   prefix in that order: two sets similar enough share an n-gram of their prefixes, and passages that
   many unlike documents share do not stand in prefixes. Order changes the work, never the result.
3. Nodes that share a prefix n-gram and pass the size, position and bitmap bounds (all of them
   exact) are candidates. Of n-grams with very many nodes only a chain of nodes is emitted. Every link lies
   within one component of the candidates.
4. The components' sets are fetched and joined: the sets, in one order, form a prefix tree; each
   set walks it, counting a shared beginning once, and leaves subtrees that cannot reach the
   threshold with what remains, or whose sets it is connected with already.
5. Links give classes; a class is named by its smallest doc_id.

A component beyond ``task_grams`` is cut into blocks, which are joined pair by pair of blocks, so that
no task holds more than two of them.

Documents without words have empty sets and link with nothing: each is its own class. Null texts
are empty. Repeated rows have equal sets and link (if not empty). Rows with a null ``doc_id`` link
nothing; they get the class of a row with an equal set, or null. Words, n-grams and sets are named by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmark.llm.graph import components
from brookmark.llm.text import batch_of, map_batches, packed, raw, rolling, signed, staged, unpack, word_hashes

SKETCH_BITS = 512  # of the smallest bitmap


def gram_set(text: bytes | None, n: int = 5) -> np.ndarray:
    """Sorted hashes of the distinct n-grams; of a shorter text, its whole word sequence as one."""
    h = word_hashes((text or b"").lower().split())
    if not len(h):
        return h
    if len(h) < n:  # shorter sequences are told apart by their length
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), len(h))], np.uint64)
    return np.unique(rolling(h, n))


def _digest(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) if len(grams) else 0


def sketch_of(grams: np.ndarray) -> bytes:
    """Bitmap with a bit or more per n-gram: bit j tells whether an odd number of n-grams falls on j.

    Two bitmaps of one length differ in at most as many bits as their sets do in n-grams. The length is a power of two,
    and halves laid over each other give the bitmap of half the length.
    """
    bits = SKETCH_BITS
    while bits < len(grams):
        bits *= 2
    odd = np.bincount((grams >> np.uint64(32)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """A lower bound of the number of n-grams in one of the two sets only."""
    if len(a) > len(b):
        a, b = b, a
    x, size = int.from_bytes(b, "little"), 8 * len(b)
    while size > 8 * len(a):
        size //= 2
        x = (x >> size) ^ (x & ((1 << size) - 1))
    return (x ^ int.from_bytes(a, "little")).bit_count()


def least_overlap(a, b):
    """Smallest intersection at which sets of sizes a and b are linked (integer, exact)."""
    return -(-4 * (a + b) // 9)  # 100 i >= 80 (a + b - i)


def prefix_size(n: int) -> int:
    """How many n-grams of a set's beginning must meet those of any set it links with."""
    return n - -(-4 * n // 5) + 1 if n else 0


def describe(docs: DataFrame, n: int = 5) -> DataFrame:
    """doc_id, n_shingles, node and sketch of every document."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [gram_set(text, n) for text in raw(batch.column("text"))]
        return batch_of(
            doc_id=batch.column("doc_id"), n_shingles=np.array([len(s) for s in sets], np.int64),
            node=signed(np.array([_digest(s) for s in sets], np.uint64)), sketch=pa.array([sketch_of(s) for s in sets], pa.binary()),
        )

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_shingles long, node long, sketch binary")


def last_in_order(docs: DataFrame, n: int = 5, bits: int = 1 << 26, shared_by: int = 24, chunk: int = 2_000_000) -> np.ndarray:
    """Bitmap of the n-grams that go last: 8 MB whatever the input; others may fall on a set bit.

    Counted are the n-grams that would stand in a prefix or half as far behind it if hashes alone
    gave the order, by the bit they fall on and over all documents; sums over a chunk of
    n-grams leave the scan.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def counted() -> pa.RecordBatch:
            slots, times = np.unique(np.concatenate(held), return_counts=True)
            return batch_of(slot=slots, times=times.astype(np.int32))

        for batch in batches:
            for text in raw(batch.column("text")):
                grams = gram_set(text, n)
                node = _digest(grams)
                if node in seen or not len(grams):
                    continue
                seen.add(node)
                front = grams[: -(-3 * prefix_size(len(grams)) // 2)]
                held.append((front & np.uint64(bits - 1)).astype(np.int32))
                size += len(front)
                if size >= chunk:
                    yield counted()
                    held, size, seen = [], 0, set()
        if held:
            yield counted()

    slots = docs.select("text").mapInArrow(run, "slot int, times int").groupBy("slot").agg(F.sum("times").alias("times"))
    words = slots.where(F.col("times") >= shared_by).groupBy(F.expr("slot div 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, slot % 64))").alias("set")
    ).toArrow()  # at most bits / 64 rows
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("set").to_numpy()
    return out.view(np.uint64)


def prefixes(docs: DataFrame, last: np.ndarray, n: int = 5) -> DataFrame:
    """(gram, node, place): the prefixes of all nodes; place holds the set's size and the position."""
    shared = docs.sparkSession.sparkContext.broadcast(last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, seen = shared.value, set()
        bits = np.uint64(64 * len(late))
        for batch in batches:
            grams, nodes, places = [], [], []
            for text in raw(batch.column("text")):
                own = gram_set(text, n)
                node = _digest(own)
                if not len(own) or node in seen:
                    continue
                if len(seen) > 100_000:
                    seen.clear()
                seen.add(node)
                at = own % bits
                is_late = (late[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
                size = prefix_size(len(own))
                first = own[~is_late][:size]
                if len(first) < size:
                    first = np.concatenate([first, own[is_late][: size - len(first)]])
                grams.append(first)
                nodes.append(np.full(size, node, np.uint64))
                places.append((np.int64(len(own)) << np.int64(32)) + np.arange(size))
            if grams:
                yield batch_of(gram=signed(np.concatenate(grams)), node=signed(np.concatenate(nodes)), place=np.concatenate(places))

    return docs.select("text").mapInArrow(run, "gram long, node long, place long")


def meetings(entries: DataFrame, most: int = 32) -> DataFrame:
    """(a, b, na, nb, sure): pairs of nodes that share a prefix n-gram and pass the size and position bounds.

    An n-gram with more than ``most`` nodes gives a chain through its nodes instead (``sure``), which keeps
    them in one component without a bound to check.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, chained = [np.zeros(0, np.int64)] * 3, False
        for batch in _with_end(batches):
            new = [np.zeros(0, np.int64)] * 3 if batch is None else [batch.column(c).to_numpy() for c in ("gram", "node", "place")]
            gram, node, place = (np.concatenate(x) for x in zip(rest, new))
            if not len(gram):
                continue
            fresh = np.r_[True, (gram[1:] != gram[:-1]) | (node[1:] != node[:-1])]  # copies met in other tasks
            gram, node, place = gram[fresh], node[fresh], place[fresh]
            starts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
            sizes = np.diff(np.r_[starts, len(gram)])
            long = sizes > most
            long[0] |= chained  # a long run began in an earlier batch
            # the last run may go on in the next batch: a short one waits whole, of a long one the last row
            chained = bool(batch is not None and long[-1])
            wait = len(gram) if batch is None else len(gram) - 1 if chained else int(starts[-1])
            upto = len(gram) if chained else wait
            rest = [gram[wait:], node[wait:], place[wait:]]
            if pairs := _pairs(gram[:upto], node[:upto], place[:upto], np.repeat(long, sizes)[:upto], most):
                yield batch_of(**dict(zip(("a", "b", "na", "nb", "sure"), pairs)))

    dealt = entries.repartition("gram").sortWithinPartitions("gram", "node")
    return dealt.mapInArrow(run, "a long, b long, na long, nb long, sure long").groupBy("a", "b").agg(
        F.first("na").alias("na"), F.first("nb").alias("nb"), F.max("sure").alias("sure")
    )


def _pairs(gram, node, place, long, most: int) -> list[np.ndarray] | None:
    """Pairs within the runs of equal n-grams: all in short runs, neighbours in long ones."""
    size, at, found = place >> 32, place & 0xFFFFFFFF, []
    for k in range(1, most):
        i = np.flatnonzero(gram[k:] == gram[:-k]) if k < len(gram) else np.zeros(0, int)
        if k > 1:
            i = i[~long[i]]
        if not len(i):
            break
        j = i + k
        can = 1 + np.minimum(size[i] - at[i], size[j] - at[j]) - 1
        fit = (5 * np.minimum(size[i], size[j]) >= 4 * np.maximum(size[i], size[j])) & (can >= least_overlap(size[i], size[j]))
        ok = (node[i] != node[j]) & (long[i] | fit)
        i, j = i[ok], j[ok]
        a, b = np.where(node[i] > node[j], j, i), np.where(node[i] > node[j], i, j)
        found.append(np.stack([node[a], node[b], size[a], size[b], long[i].astype(np.int64)]))
    if not found:
        return None
    return list(np.unique(np.concatenate(found, 1), axis=1))


def _with_end(batches):
    yield from (b for b in batches if b.num_rows)
    yield None


def candidates(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose bitmaps do not rule a link out; chains stay as they are."""
    side = {x: nodes.select(F.col("node").alias(x), F.col("sketch").alias(f"s{x}")) for x in "ab"}

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = [batch.column(c).to_numpy() for c in ("na", "nb")]
        most = n[0] + n[1] - 2 * least_overlap(*n)
        near = map(bits_apart, batch.column("sa").to_pylist(), batch.column("sb").to_pylist())
        keep = pa.array(np.flatnonzero(np.fromiter(near, np.int64, len(most)) <= most))
        return batch_of(a=batch.column("a").take(keep), b=batch.column("b").take(keep))

    both = pairs.where("sure = 0").select("a", "b", "na", "nb").join(side["a"], "a").join(side["b"], "b")
    return map_batches(both, check, "a long, b long").unionByName(pairs.where("sure = 1").select("a", "b"))


class PrefixTree:
    """Sets in one order as a tree of shared beginnings; nodes are flat lists, children follow parents."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.sets = [sets[i] for i in self.order]
        #: per node: depth it begins and ends at, first and last set below, children, size bounds
        self.nodes: list[list] = []
        self.root = self._grow(0, len(sets), 0) if sets else None

    def _grow(self, low: int, high: int, depth: int) -> int:
        """Tree of the sets low..high-1, which agree up to ``depth``; built without recursion."""
        top, work = None, [(low, high, depth, None)]
        while work:
            low, high, depth, parent = work.pop()
            first, end = self.sets[low], self.sets[high - 1]
            n = min(len(first), len(end))
            differ = np.flatnonzero(first[depth:n] != end[depth:n])
            stop = depth + (int(differ[0]) if len(differ) else n - depth) if high - low > 1 else len(first)
            sizes = [len(self.sets[i]) for i in (range(low, high))]
            me = len(self.nodes)
            self.nodes.append([depth, stop, low, high, [], min(sizes), max(sizes)])
            if parent is None:
                top = me
            else:
                self.nodes[parent][4].append(me)
            if high - low == 1:
                continue
            i = low
            while i < high and len(self.sets[i]) == stop:
                i += 1  # a set that ends here is a beginning of the others; sets are distinct
            begin = i
            if begin > low:
                self.nodes.append([stop, stop, low, begin, [], stop, stop])
                self.nodes[me][4].append(len(self.nodes) - 1)
            while i < high:
                head, j = self.sets[i][stop], i + 1
                while j < high and self.sets[j][stop] == head:
                    j += 1
                work.append((i, j, stop, me))
                i = j
        return top

    def links(self) -> list[tuple[int, int]]:
        """A spanning set of the links: pairs of positions of the given sets."""
        up = list(range(len(self.sets)))

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        found, classes = [], len(self.sets)
        for x, own in enumerate(self.sets):
            if classes == 1:
                break
            size, work = len(own), [(self.root, 0)]
            while work:
                at, overlap = work.pop()
                begin, stop, low, high, below, least, most = self.nodes[at]
                if high <= x + 1 or 5 * most < 4 * size or 4 * least > 5 * size:
                    continue
                leaf = high - low == 1
                if leaf and find(low) == find(x):
                    continue
                left = size
                if stop > begin:
                    edge = self.sets[low][begin:stop]
                    place = np.searchsorted(own, edge)
                    overlap += int((own[np.minimum(place, size - 1)] == edge).sum())
                    left = size - int(place[-1])
                if 9 * (overlap + min(left, most - stop)) < 4 * (size + least):
                    continue
                if leaf:
                    found.append((self.order[x], self.order[low]))
                    up[find(low)] = find(x)
                    classes -= 1
                else:
                    work.extend((child, overlap) for child in below)
        return found


def class_links(routed: DataFrame, n: int = 5) -> DataFrame:
    """(a, b): links found in each task group; ``routed`` has part, node and packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nodes, sets = None, [], []

        def joined() -> pa.RecordBatch:
            known = {node: s for node, s in zip(nodes, sets)}
            names = list(known)
            pairs = PrefixTree(list(known.values())).links() if len(names) > 1 else []
            return batch_of(a=pa.array([names[i] for i, _ in pairs], pa.int64()), b=pa.array([names[j] for _, j in pairs], pa.int64()))

        for batch in batches:
            for now, node, text in zip(batch.column("part").to_pylist(), batch.column("node").to_pylist(), unpack(batch.column("packed"))):
                if now != part:
                    if len(nodes) > 1:
                        yield joined()
                    part, nodes, sets = now, [], []
                grams = gram_set(text, n)
                if int(signed(np.array([_digest(grams)], np.uint64))[0]) == node:  # another row of that id has another set
                    nodes.append(node)
                    sets.append(grams)
        if len(nodes) > 1:
            yield joined()

    return routed.repartition("part").sortWithinPartitions("part").mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, n: int = 5, task_grams: int = 2_000_000) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``node`` and ``component_id`` of every row."""
    members = staged(describe(docs, n))
    nodes = staged(
        members.where("n_shingles > 0 and doc_id is not null").groupBy("node").agg(
            F.min("doc_id").alias("least"), F.max("n_shingles").alias("size"), F.max("sketch").alias("sketch")
        )
    )
    known = docs.where(F.col("doc_id").isNotNull())
    pairs = staged(meetings(prefixes(known, last_in_order(known, n), n)))
    groups = staged(components(candidates(pairs, nodes)))

    # what each component weighs decides on its blocks; every set goes to as many tasks as it has blocks
    sized = groups.join(nodes.select("node", "least", "size"), "node")
    blocks = sized.groupBy("root").agg(F.ceil(F.sum("size") / task_grams).cast("int").alias("blocks"))
    dealt = sized.join(blocks, "root").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = dealt.select("node", "least", "root", "own", other.alias("other")).select(
        "node", "least", F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("part")
    )
    texts = packed(docs, "doc_id").join(
        sized.select(F.col("least").alias("doc_id"), "node"), "doc_id"
    )
    routed = tasks.select("node", "part").join(texts.select("node", "packed"), "node")
    links = class_links(routed, n)

    named = components(links).join(nodes.select("node", "least"), "node")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = named.select("node", "root").join(least, "root").select(F.col("node").alias("of"), "component_id")
    own = nodes.select(F.col("node").alias("alone"), F.col("least"))
    return (
        members.select("doc_id", "n_shingles", "node")
        .join(found, F.col("node") == F.col("of"), "left").join(own, F.col("node") == F.col("alone"), "left")
        .select("doc_id", "n_shingles", "node", F.coalesce("component_id", "least", "doc_id").alias("component_id"))
    )


def keep_one(docs: DataFrame, n: int = 5) -> DataFrame:
    """One document of each class, the one that names it; with the columns they came with.

    Of repeated rows of that ``doc_id`` all stay; rows without a ``doc_id`` stay.
    """
    found = classes(docs.select("doc_id", "text"), n).where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    kept = docs.where("doc_id is not null").join(found, F.col("doc_id") == F.col("__kept"), "left_semi")
    return kept.unionByName(docs.where("doc_id is null"))
