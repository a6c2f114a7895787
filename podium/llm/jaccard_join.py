"""N-gram Jaccard join: T-occurrence search with DivideSkip over distributed inverted lists.

Two documents link when their sets of k-word shingles have a Jaccard similarity
of at least ``num / den``.  Then they share at least ``T = ceil(n * num / den)``
shingles for either size ``n``, so in any global order of shingles the first
``n - T + 1 + SKIP`` of each share at least ``1 + SKIP``: only these are indexed.

1. :func:`frequent`: counts of shingles that repeat inside a batch, over all
   documents; they put common shingles last in the order.
2. :func:`signatures`: per document its set's size, signature and indexed
   shingles.  Documents of one set (copies) become one class.
3. Inverted lists: postings partitioned by shingle and sorted by size; shingles
   of a single class are dropped.
4. Contraction: the first class of each size range is a list's centre, and every
   class is compared with the centre it shares most lists with.  Verified links
   make components, so that the lists of a large group of near copies have a
   single label and are done with.
5. T-occurrence search over the lists with several labels: a document skips up
   to ``SKIP`` of its longest lists if they are long (DivideSkip), heap-merges
   the others and keeps the candidates whose count can still reach
   ``1 + SKIP``; lists hold only documents of another label whose parity bits
   allow the similarity (:func:`_parity`).  Two rounds try the
   candidates of the highest counts first (``CONTRACTIONS``) and merge labels, so
   that a large group that is linked only in chains is soon one label; the last
   round tries every candidate left.  A class all of whose candidates were tried
   is done: a later round searches for the others only, in their lists only.
6. Candidates are compared exactly: one document's sorted shingles are
   binary-probed for the other's, the skipped lists' shingles included.

A list is streamed sorted by size, and only the part within the similarity's
size range is held.  No link between different sets is lost; links inside a
component already known are not listed again.  Shingles and sets are compared
by 58- and 64-bit hashes (a wrong merge of two classes among N is expected
N^2 / 2^65 times), and by 40 bits in the comparison of a pair (one shingle too
many is counted about n^2 / 2^40 times).

Defined results: null, empty and blank texts have an empty set and link with
nothing; a text with fewer than k words is one shingle; rows with a null id form
no links and get a null component unless a copy has an id; rows that repeat an
id are separate rows of that id; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from podium.llm import textkernel as tk
from podium.llm.common import mapped, salted_join, staged, table, unstage
from podium.llm.components import components

#: lists a document may skip; documents below SMALL shingles skip none
SKIP, SMALL = 8, 32
#: lists up to this length are always merged
SHORT = 64
#: frequent shingles told to every task (9 bytes each); the order of the rest is by hash alone
FREQUENT = 1 << 18
#: candidates of each class tried in the rounds before all remaining ones are
CONTRACTIONS = (2, 4)
_BITS = np.uint64(6)


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row; hashes have 58 bits."""
    for w in tk.words(column):
        h, at = w.shingles(k)
        h = h >> _BITS
        cut = np.searchsorted(at, w.first)
        for r in range(len(w.first) - 1):
            a, b = cut[r], cut[r + 1]
            if b > a:
                s = np.sort(h[a:b])
                yield w.row0 + r, s[np.append(True, s[1:] != s[:-1])]
            elif w.first[r + 1] > w.first[r]:
                few = w.hash[w.first[r] : w.first[r + 1]]
                with np.errstate(over="ignore"):
                    x = np.uint64(len(few))
                    for one in few:
                        x = tk.mix64(np.atleast_1d(x * np.uint64(0xD6E8FEB86659FD93) + one))[0]
                yield w.row0 + r, np.array([x >> _BITS], np.uint64)
            else:
                yield w.row0 + r, np.empty(0, np.uint64)


def _node(s: np.ndarray) -> int:
    """The set's signature: equal for equal sets."""
    with np.errstate(over="ignore"):
        both = np.array([tk.mix64(s).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)
        return int((tk.mix64(both) ^ tk.mix64(np.bitwise_xor.reduce(s, keepdims=True)))[0].astype(np.int64))


def _parity(s: np.ndarray, n: int) -> bytes:
    """The set's parity bits: bit ``h mod size`` of every element h, added modulo 2.

    Two sets' bits differ in no more places than the sets differ in elements, so
    bits that differ in too many rule a pair out.  The number of bits is a power
    of two from twice to four times ``n``, within bounds; halves added to each
    other are the bits of half the size, so sets of any sizes compare.
    """
    size = min(max(256, 1 << (2 * n - 1).bit_length()), 1 << 13)
    places = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(places.astype(np.uint8), bitorder="little").tobytes()


def frequent(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (sorted) and the bit length of their counts.

    A batch counts each shingle once per distinct set and reports those in four
    sets or more; the reports are summed over all batches.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[int, np.ndarray] = {}
            for _, s in _sets(b.column(0), k):
                if len(s):
                    seen.setdefault(_node(s), s)
            if seen:
                h, n = np.unique(np.concatenate(list(seen.values())), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h[n >= 4].astype(np.int64)), pa.array(n[n >= 4])], ["h", "n"])

    counts = mapped(docs.select("text"), count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    h = top["h"].to_numpy().astype(np.uint64)
    level = (np.floor(np.log2(top["n"].to_numpy().astype(float))) + 1).astype(np.uint64)
    order = np.argsort(h)
    return h[order], level[order]


def signatures(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n, node (signature of the set), keys (the indexed shingles in global order, 8 bytes each) and parity bits."""
    common = docs.sparkSession.sparkContext.broadcast(frequent(docs, k))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, level = common.value
        for b in batches:
            size, node, keys, bits = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64), [b""] * len(b), [b""] * len(b)
            for r, s in _sets(b.column(1), k):
                n = size[r] = len(s)
                if not n:
                    continue
                node[r], bits[r] = _node(s), _parity(s, n)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    s = np.sort(np.where(hot[at] == s, level[at] << np.uint64(58), np.uint64(0)) | s)
                keys[r] = s[: n + (-n * num // den) + 1 + (SKIP if n >= SMALL else 0)].tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(node), pa.array(keys, pa.binary()), pa.array(bits, pa.binary())], ["doc_id", "n", "node", "keys", "bits"])

    return mapped(docs.select(F.col("doc_id").cast("long"), "text"), sign, "doc_id long, n long, node long, keys binary, bits binary")


def _postings(classes: DataFrame) -> DataFrame:
    """One row (key, n, node) per indexed shingle of a class."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), 2000):
                c = b.slice(lo, 2000)
                keys = [np.frombuffer(x, np.int64) for x in c.column(2).to_pylist()]
                count = [len(x) for x in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.repeat(c.column(1).to_numpy(), count)), pa.array(np.repeat(c.column(0).to_numpy(), count))],
                    ["key", "n", "node"],
                )

    return mapped(classes.select("node", "n", "keys"), spread, "key long, n long, node long")


def _by_list(postings: DataFrame) -> DataFrame:
    return postings.repartition("key").sortWithinPartitions("key", "n", "node")


def _shared(postings: DataFrame, num: int, den: int) -> DataFrame:
    """Postings of shingles that two classes have, with ``center``: the list's first class of about their size."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3  # the last row so far, not yet given out
        before, center, band_was = None, 0, 0  # key of the row before it; centre and band of that row
        for b in _and_end(batches):
            rows = held if b is None else [np.concatenate((h, c.to_numpy())) for h, c in zip(held, b.columns)]
            key, n, node = rows
            if not len(key):
                continue
            last = len(key) if b is None else len(key) - 1
            same = np.empty(len(key), bool)  # as the row before
            same[0] = before is not None and key[0] == before
            same[1:] = key[1:] == key[:-1]
            band = np.floor(np.log(n) / np.log(den / num)).astype(np.int64)
            opens = ~same
            opens[1:] |= band[1:] != band[:-1]
            opens[0] |= band[0] != band_was
            run = np.maximum.accumulate(np.where(opens, np.arange(len(key)), -1))
            centers = np.where(run >= 0, node[run], center)
            keep = same.copy()
            keep[:-1] |= same[1:]
            keep[last:] = False
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (key, n, node, centers)], ["key", "n", "node", "center"])
            if last:
                before, center, band_was = key[last - 1], centers[last - 1], band[last - 1]
            held = [x[last:] for x in rows]

    return mapped(_by_list(postings), scan, "key long, n long, node long, center long")


def _and_end(batches):
    yield from batches
    yield None


#: bytes of a shingle's hash that are compared exactly
EXACT = 5


def _packed(s: np.ndarray) -> bytes:
    """The low ``EXACT`` bytes of each hash, sorted; ``_unpacked`` gives them back as numbers."""
    low = np.unique(s & np.uint64((1 << 8 * EXACT) - 1))
    return low.view(np.uint8).reshape(-1, 8)[:, :EXACT].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // EXACT, 8), np.uint8)
    out[:, :EXACT] = np.frombuffer(raw, np.uint8).reshape(-1, EXACT)
    return out.reshape(-1).view(np.uint64)


def verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity.

    Each class's text is read once and its shingles are sent to where they are
    compared: ``a``'s are held there while its partners' stream past.  A class
    with many partners is dealt to several tasks.
    """
    pairs = staged(pairs, "pairs")
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / 256).cast("int").alias("parts"))
    dealt = pairs.join(degree.hint("merge"), "a")
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    ends = dealt.select(F.col("b").alias("node"), F.struct("a", part.alias("part"), F.lit(1).alias("kind")).alias("to"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    heads = degree.select("a", every.alias("part")).select(F.col("a").alias("node"), F.struct("a", "part", F.lit(0).alias("kind")).alias("to"))
    sent = ends.unionByName(heads).groupBy("node").agg(F.collect_list("to").alias("to"))
    named = sent.join(classes.select("node", "rep"), "node")
    # the classes follow the corpus, so they are never broadcast, and the plan is the same at every size
    texts = docs.select("doc_id", "text").join(named.hint("merge"), F.col("doc_id") == F.col("rep")).select("node", "text", "to")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()  # rows that repeat an id lie in one task; the first with the class's set counts
        for b in batches:
            node, rows, size = b.column(0).to_numpy(), [], 0
            for r, s in _sets(b.column(1), k):
                if len(s) and int(node[r]) not in done and _node(s) == node[r]:
                    done.add(int(node[r]))
                    raw = _packed(s)
                    for t in b.column(2)[r].as_py():
                        rows.append((t["a"], t["part"], t["kind"], int(node[r]), raw))
                        size += len(raw)
                    if size > 1 << 23:
                        yield _sent(rows)
                        rows, size = [], 0
            yield _sent(rows)

    def _sent(rows):
        cols = list(zip(*rows)) or [()] * 5
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["a", "part", "kind", "b", "shingles"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, mine = None, np.empty(0, np.uint64)
        for b in batches:
            left, right = [], []
            for a, kind, other, raw in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4))):
                s = _unpacked(raw)
                if kind == 0:
                    head, mine = a, s
                elif head == a:
                    few, many = (s, mine) if len(s) < len(mine) else (mine, s)
                    both = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
                    if den * both >= num * (len(s) + len(mine) - both):
                        left.append(a)
                        right.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    rows = mapped(texts, send, "a long, part int, kind int, b long, shingles binary")
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", "kind", "b")
    out = staged(mapped(rows, compare, "a long, b long"), "links")
    unstage(pairs)
    return out


class _List:
    """The part of one list that documents still to come may be compared with, in order of size."""

    def __init__(self):
        self.n = self.node = self.label = self.width = self.first = np.empty(0, np.int64)
        self.bits = np.empty(0, np.uint64)

    def add(self, n: np.ndarray, node: np.ndarray, label: np.ndarray, bits: list[bytes]) -> None:
        self.n, self.node, self.label = (np.concatenate(x) for x in ((self.n, n), (self.node, node), (self.label, label)))
        self.width = np.concatenate((self.width, np.array([len(x) // 8 for x in bits], np.int64)))
        self.bits = np.concatenate((self.bits, np.frombuffer(b"".join(bits), np.uint64)))
        self.first = np.cumsum(self.width) - self.width

    def cut(self, least: int) -> int:
        """Drop documents below ``least`` shingles; how many went."""
        lo = int(np.searchsorted(self.n, least))
        if lo:
            self.bits = self.bits[int(self.first[lo]) if lo < len(self.n) else len(self.bits) :]
            self.n, self.node, self.label, self.width = self.n[lo:], self.node[lo:], self.label[lo:], self.width[lo:]
            self.first = np.cumsum(self.width) - self.width
        return lo

    def before(self, i: int, num: int, den: int) -> np.ndarray:
        """Sorted documents ahead of the i-th, of another label, that size and parity bits let reach the similarity."""
        n, lo = int(self.n[i]), int(np.searchsorted(self.n, -(-int(self.n[i]) * num // den)))
        other = self.label[lo:i] != self.label[i]
        if not other.any():
            return np.empty(0, np.int64)
        mine = self.bits[self.first[i] : self.first[i] + self.width[i]]
        while lo < i:
            # widths rise with sizes, so those of one width lie together
            width = int(self.width[lo])
            hi = min(i, int(np.searchsorted(self.width, width, "right")))
            theirs = self.bits[self.first[lo] : self.first[hi - 1] + width].reshape(hi - lo, width)
            apart = np.bitwise_count(theirs ^ np.bitwise_xor.reduce(mine.reshape(-1, width))).sum(axis=1, dtype=np.int64)
            other[lo - i : hi - i or None] &= (den + num) * apart <= (den - num) * (self.n[lo:hi] + n)
            lo = hi
        return np.sort(self.node[i - len(other) : i][other])


def _candidates(
    lists: DataFrame, bits: DataFrame, num: int, den: int, best: int | None = None, undone: DataFrame | None = None
) -> DataFrame:
    """(a, b, rank): classes of different labels whose count over the merged lists can reach the required overlap.

    ``lists``: key, n, node, label of lists with several labels; ``bits``: the
    parity bits of every node.  ``rank`` numbers the candidates of each ``a``
    from 1, the highest counts first; ``best`` keeps only so many and one more,
    which tells that not all are kept.  With ``undone`` only those nodes are
    searched for (all their lists must be there).
    """
    sized = lists.join(lists.groupBy("key").agg(F.count("*").alias("long")), "key")
    rank = F.row_number().over(W.partitionBy("node").orderBy(F.desc("long"), "key"))
    least = F.ceil(F.col("n") * num / den)
    skips = (F.col("long") > SHORT) & (rank <= SKIP) & (least >= SMALL)
    dealt = sized.withColumn("skipped", skips).withColumn("n_skipped", F.sum(F.col("skipped").cast("int")).over(W.partitionBy("node")))
    dealt = dealt.join(bits.hint("merge"), "node")
    if undone is not None:
        dealt = dealt.join(undone.withColumn("undone", F.lit(True)), "node", "left")
        dealt = dealt.withColumn("skipped", F.col("skipped") | F.col("undone").isNull())

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each merged list of a document, the sorted documents before it that may be its partners."""
        now, held = None, _List()
        for whole in batches:
            for lo in range(0, len(whole), 2048):
                b = whole.slice(lo, 2048)
                key, n, node, label = (b.column(i).to_numpy() for i in range(4))
                skipped, n_skipped = b.column(4).to_numpy(zero_copy_only=False), b.column(5).to_numpy()
                raw = b.column(6).to_pylist()
                edge = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
                out: list[tuple[int, int, int, bytes]] = []
                size = 0
                for x, y in zip(edge[:-1], edge[1:]):
                    if key[x] != now:
                        now, held = key[x], _List()
                    else:
                        held.cut(-(-int(n[x]) * num // den))
                    at = len(held.n)
                    held.add(n[x:y], node[x:y], label[x:y], raw[x:y])
                    for i in range(x, y):
                        if skipped[i] or at + i - x == 0:
                            continue
                        got = held.before(at + i - x, num, den)
                        if len(got):
                            out.append((int(node[i]), int(n[i]), int(n_skipped[i]), got.tobytes()))
                            size += 8 * len(got)
                            if size > 1 << 22:
                                yield _rows(out)
                                out, size = [], 0
                yield _rows(out)

    def _rows(out):
        cols = list(zip(*out)) or [(), (), (), ()]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["a", "n", "skipped", "before"])

    tail = mapped(_by_list(dealt.select("key", "n", "node", "label", "skipped", "n_skipped", "bits")), tails, "a long, n long, skipped long, before binary")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Heap-merge of a document's lists; candidates need 1 + SKIP occurrences, less the lists skipped."""

        def found(a, n, skipped, runs):
            # a partner has at least the similarity's share of n; below SMALL it indexes no extra shingles
            need = max(1, 1 + SKIP - skipped) if -(-n * num // den) >= SMALL else 1
            counted = ((sum(1 for _ in same), other) for other, same in groupby(heapq.merge(*runs)))
            reached = (x for x in counted if x[0] >= need)
            for rank, (_, other) in enumerate(reached if best is None else heapq.nlargest(best + 1, reached), 1):
                out.append((a, other, rank))

        def ranked():
            cols = list(zip(*out)) or [()] * 3
            types = (pa.int64(), pa.int64(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["a", "b", "rank"])

        head, runs, out = None, [], []
        for b in batches:
            for a, n, skipped, raw in zip(*(c.to_pylist() for c in b.columns)):
                if head is not None and a != head[0]:
                    found(*head, runs)
                    runs = []
                    if len(out) > 1 << 16:
                        yield ranked()
                        out = []
                head = (a, n, skipped)
                runs.append(np.frombuffer(raw, np.int64).tolist())
        if head is not None:
            found(*head, runs)
        yield ranked()

    return mapped(tail.repartition("a").sortWithinPartitions("a"), merge, "a long, b long, rank int")


def join(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = staged(signatures(docs, k, num, den), "signed")
    known = signed.where("n > 0").groupBy("node", "n").agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"), F.first("bits").alias("bits"))
    keyed = staged(known, "keyed")
    marks = staged(signed.select("doc_id", "n", "node"), "marks")
    unstage(signed)
    lists = staged(_shared(_postings(keyed.where("rep IS NOT NULL")), num, den), "lists")
    classes = staged(keyed.select("node", "rep", "bits"), "classes")
    unstage(keyed)
    usable = classes.where("rep IS NOT NULL")
    # each class is compared with the centre it shares most lists with; step 5 finds all other links
    shared = lists.where("center != node").groupBy("center", "node").agg(F.count("*").alias("n"))
    nearest = shared.groupBy("node").agg(F.max(F.struct("n", "center")).alias("best"))
    star = verified(docs, usable, nearest.select(F.col("best.center").alias("a"), F.col("node").alias("b")), k, num, den)
    links, undone = star, None
    for best in (*CONTRACTIONS, None):
        known = staged(components(links), "contracted")
        if undone is not None:
            # labels only merge, so the lists with several labels are among those of the round before
            held = lists.join(undone, "node").select("key").distinct()
            lists_of = lists.join(held, "key", "left_semi")
        else:
            lists_of = lists
        labelled = lists_of.select("key", "n", "node").join(known, "node", "left").select("key", "n", "node", F.coalesce("component", "node").alias("label"))
        open_ = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("key")
        several = staged(labelled.join(open_, "key"), "several")
        unstage(known, lists)
        lists = several
        pairs = staged(_candidates(several, usable.select("node", "bits"), num, den, best, undone), "candidates")
        tried = pairs if best is None else pairs.where(F.col("rank") <= best)
        links = links.unionByName(verified(docs, usable, tried.select("a", "b"), k, num, den))
        if best is not None:
            undone = staged(pairs.where(F.col("rank") > best).select(F.col("a").alias("node")).distinct(), "undone")
            unstage(pairs)
            if undone.isEmpty():
                break
    whole = staged(components(links), "components")
    names = usable.select("node", "rep").join(whole, "node").groupBy("component").agg(F.min("rep").alias("least"))
    placed = classes.select("node", "rep").join(whole, "node", "left")
    named = salted_join(placed, names, ["component"], F.col("node"))
    final = staged(named.select("node", F.coalesce("least", "rep").alias("named")), "named")
    unstage(lists, whole, classes)
    out = salted_join(marks, final, ["node"], F.coalesce("doc_id", F.lit(0)))
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("named"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` with one document, that of the smallest id (null last), of each linked group.

    Rows are told apart by id and text: of rows equal in both one stays, other
    rows of an id are judged each by its own text, and rows with a null id join
    the group of their text.  Texts without words link with nothing and stay.
    """
    key = F.col("doc_id").cast("long")
    row = [F.xxhash64(key, "text").alias("_row"), key.alias("_id"), F.col("text").alias("_text")]
    whole = docs.select(*row, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    # copies without an id are one row from here on, dropped before they meet
    nameless = staged(whole.where("_id IS NULL").dropDuplicates(["_row"]), "nameless")
    rows = whole.where("_id IS NOT NULL").unionByName(nameless)
    found = join(rows.select(F.col("_row").alias("doc_id"), F.col("_text").alias("text")), k, num, den)
    groups = found.select(F.col("doc_id").alias("_row"), "component_id").distinct()
    ids = rows.select("_row", "_id").distinct()
    first = F.min(F.struct(F.col("_id").isNull().alias("last"), "_id", "_row")).alias("first")
    least = groups.join(ids.hint("merge"), "_row").groupBy("component_id").agg(first)
    kept = staged(least.select(F.col("first._row").alias("_kept")), "kept")
    stay = rows.join(kept.hint("merge"), F.col("_row") == F.col("_kept")).dropDuplicates(["_row"])
    return stay.select("doc.*")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents
), s AS MATERIALIZED (
  SELECT doc_id, list_sort(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 4 THEN [array_to_string(l, ' ')]
    ELSE list_distinct(list_transform(range(1, len(l) - 2), lambda i: array_to_string(l[i:i + 3], ' '))) END) AS g FROM w
), c AS MATERIALIZED (
  SELECT min(doc_id) AS rep, g FROM s WHERE len(g) > 0 GROUP BY g
), p AS (
  SELECT rep, len(g) AS n, unnest(g) AS h FROM c
), e AS (
  SELECT a.rep AS a, b.rep AS b FROM p a JOIN p b ON a.h = b.h AND a.rep < b.rep
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), g AS (
  SELECT a, b FROM e UNION SELECT b, a FROM e
), r(node, other) AS (
  SELECT rep, rep FROM c UNION SELECT r.node, g.b FROM r JOIN g ON r.other = g.a
), m AS (
  SELECT node, min(other) AS least FROM r GROUP BY node
)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, CASE WHEN len(s.g) = 0 THEN s.doc_id ELSE m.least END AS component_id
FROM s LEFT JOIN c ON s.g = c.g LEFT JOIN m ON c.rep = m.node
"""
