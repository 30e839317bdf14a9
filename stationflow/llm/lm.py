"""Language-model scores from a hashed maximum-entropy model.

Vocabulary: every token of the training documents is counted. The `head` most frequent words (a documented bound) go to the tasks as
arrays; all others, the tail, are looked up by a join, so the vocabulary may grow with the corpus.

Model: P(token | history) = P(class | history) * P(token | class). There are CLASSES classes: the ALONE most frequent words alone, and clusters of
words that keep like company: the `core` most frequent words are clustered by the frequent words of their documents and by those just before and
after them, summed over the whole corpus; a word outside the core goes where most core words of its spelling (first and last two bytes) went. The class
softmax is log-linear in hashed features of the words before: the n-grams w1 and w1 w2 and the skips w2 and w3 (outside the core, a word's class stands for
it), and a bias. There are as many buckets as distinct training tokens, rounded up to a power of two, between LEAST_BUCKETS and MOST_BUCKETS
(what a task can hold).

Within a class (`within`): the head words and the tail, as one more word, are the leaves of a binary tree. P(word | class, history) is the product, over the
splits on the way, of log-linear probabilities of two sides: the counts' log odds and hashed features of the split along with w1 and with the skip w2. Each split
adds up to one, so the words of a class do. A word of the tail has its share of the tail by its count. Without `within`, a token's weight in its class is its bias,
whose likelihood maximum is its count in closed form. Counts of the tail are smoothed by 0.5, which keeps 0.5 for unseen words.

Training: one pass over all training documents counts how often each bucket met each class; START of the smoothed logarithm of what that says against the
class's share is the start. The same pass adds up, for each feature of a split, what the counts alone lack of the side taken, right and left; SPLIT_START of the
smoothed logarithm of their ratio is its weight, one step of iterative scaling. Then `rounds` gradient steps, each one pass from common weights: tasks add up the expected counts, and each weight moves by observed
less expected, scaled by the mass of both (which bounds a step) and PRIOR. A step waits for all tasks, so tasks do not work against each other.

Scoring: each task scores chunks of whole texts in sparse numpy batches; every class probability is normalised exactly.

Defined results: null text counts as empty: its one token is the end. Repeated rows each give a row, and count as often in training.
No training document: all counts are 0 and every token is unknown. An empty table gives no rows. Words are told apart by 64-bit hashes. Other
columns are ignored. No result depends on how the table is split or ordered, up to rounding: what is counted is added up exactly, the expected counts in float32 between tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Words, bounded_batches, chunks, cut, mix

U64 = np.uint64
CLASSES, ALONE = 32, 8
KINDS = 4
LEAST_BUCKETS, MOST_BUCKETS = 1 << 12, 1 << 15
SPELLINGS = 1 << 16
#: Tokens of a task that adds up a matrix.
TASK = 1 << 22
#: Tokens of a batch, and of one whose splits are gone through; rows of a matrix in a row of partial sums; parts in which tasks are first added up.
BATCH, WIDE, BLOCK, SALT = 4096, 8192, 128, 64
#: Share of the counts' logarithm that a weight starts with; pseudo-counts of a bucket's start and of each step; grain of a document's signs, so that their sums are exact.
START, PRIOR, GRAIN = 0.4, 16.0, 1024
#: Words whose company is looked at, and numbers by which a word's company is told: of its documents, of the word before, of the word after.
COMPANY, SIGNS = 256, (16, 8, 8)
#: Within a class: kinds of features (w1 and the skip w2); buckets for each of the class model's; share of the pulls' logarithm that a weight takes, and its pseudo-pull;
#: tokens whose pairs with a word before are told apart at once.
SEEN, SPLIT_BUCKETS, SPLIT_START, PULL, PAIRS = (0, 2), 16, 0.4, 3.0, 1 << 20
NODE = np.uint32(0x9E3779B1)
ONES = np.ones(CLASSES, np.float32)
END = np.int64(mix(np.array([0xE0D], np.uint64)).view(np.int64)[0])
_signs = np.random.Generator(np.random.PCG64(13)).choice(np.array([-1, 1], np.float32), (COMPANY + 1, sum(SIGNS)))
_signs[COMPANY] = 0


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and spelling of every token, with each document's end, and each document's first token."""
    words = Words(buf, offs)
    n = len(offs) - 1
    at = np.arange(len(words.starts)) + words.doc()
    first = words.first + np.arange(n + 1)
    h, spelling = np.full(first[-1], END), np.zeros(first[-1], np.int64)
    h[at] = words.hashes(lower=True).view(np.int64)
    code = np.zeros(len(words.starts), np.uint64)
    long = words.ends - words.starts > 1
    for place in (words.starts, np.where(long, words.starts + 1, words.starts), words.ends - 1, np.where(long, words.ends - 2, words.starts)):
        code = code << U64(8) | LOWER[words.buf[place]].astype(np.uint64)
    spelling[at] = (mix(code + U64(1)) >> U64(48)).astype(np.int64)
    return h, spelling, first


class Head:
    """The frequent words: sorted hashes, counts and ranks by frequency; classes of words; sizes of the classes; the whole corpus's N and V."""

    def __init__(self, h: np.ndarray, counts: np.ndarray, spellings: np.ndarray, total: int, kinds: int, core: int):
        order = np.argsort(h)
        self.h, self.counts, self.rank, self.spelling = h[order], counts[order].astype(np.float64), order, spellings[order]
        self.lead = None  # found by the first look
        self.total, self.kinds, self.core = total, kinds, min(core, len(h))
        where = np.flatnonzero(self.h == END)
        self.start = int(self.rank[where[0]]) if len(where) and self.rank[where[0]] < self.core else 0

    def classify(self, of_core: np.ndarray, tail: list[tuple[int, int, int]]) -> None:
        """of_core: the class of each core word, by rank. tail: spelling, tokens, and distinct words of the tail."""
        inside = self.rank < self.core
        cls = np.zeros(len(self.h), np.int64)
        cls[inside] = of_core[self.rank[inside]]
        votes = np.zeros((SPELLINGS, CLASSES))
        np.add.at(votes, (self.spelling[inside], cls[inside]), 1.0)
        votes[:, :ALONE] = 0
        common = int(votes.sum(axis=0).argmax()) if votes.any() else CLASSES - 1
        self.by_spelling = np.where(votes.any(axis=1), votes.argmax(axis=1), common)
        cls[~inside] = self.by_spelling[self.spelling[~inside]]
        self.cls, self.symbol = cls, np.where(inside, self.rank, self.core + cls)
        self.size = np.bincount(cls, self.counts, minlength=CLASSES) + 0.5
        for e, n, v in tail:
            self.size[self.by_spelling[e]] += n + 0.5 * v
        self.mass = self.size / self.size.sum()

    def look(self, h: np.ndarray) -> np.ndarray:
        """Each token's place among the head words, or -1."""
        if not len(self.h):
            return np.full(len(h), -1)
        if self.lead is None:
            self.shift = U64(63 - len(self.h).bit_length())
            places = np.bincount(self.place(self.h), minlength=1 << 64 - int(self.shift))
            self.lead = np.concatenate([[0], np.cumsum(places)]).astype(np.int32)
            self.ended = np.append(self.h, np.iinfo(np.int64).max)
        at = np.take(self.lead, self.place(h))
        less = np.take(self.ended, at) < h
        at += less
        left = np.flatnonzero(less)
        while len(left):  # most are found by the first look
            left = left[np.take(self.ended, at[left]) < h[left]]
            at[left] += 1
        at = np.minimum(at, len(self.h) - 1)
        return np.where(self.h[at] == h, at, -1)

    def place(self, h: np.ndarray) -> np.ndarray:
        """The leading bits of hashes, in their order."""
        return ((h.view(np.uint64) ^ U64(1 << 63)) >> self.shift).astype(np.int64)

    def core_rank(self, at: np.ndarray) -> np.ndarray:
        """The rank of each token in the core, or -1."""
        if not len(self.h):
            return at
        rank = np.where(at >= 0, self.rank[at], -1)
        return np.where(rank < self.core, rank, -1)

    def classes(self, at: np.ndarray, spelling: np.ndarray) -> np.ndarray:
        return np.where(at >= 0, self.cls[at], self.by_spelling[spelling]) if len(self.h) else self.by_spelling[spelling]

    def symbols(self, at: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """What features see of a token: the word if it is of the core, else its class."""
        return np.where(at >= 0, self.symbol[at], self.core + cls) if len(self.h) else self.core + cls


class Splits:
    """Every class's words as a binary tree: a split halves the tokens of a run of words, the most frequent first; the tail is a class's last word.

    Leaves are the head words in their places, then each class's tail; nodes follow. up: twice the node above, plus one on its right side; -1 at the top.
    base: the log odds of the right side, from the counts. depth: splits above a leaf.
    place: each leaf's number from left to right; sorted: the leaves by it. against: by up, the log odds of the other side.
    """

    def __init__(self, head: Head):
        count = np.concatenate([head.counts, head.size - np.bincount(head.cls, head.counts, minlength=CLASSES)])
        cls = np.concatenate([head.cls, np.arange(CLASSES)])
        tail = np.arange(len(cls)) >= len(head.cls)
        leaf = np.lexsort((np.append(head.rank, np.arange(CLASSES)), tail, cls))
        sums = np.concatenate([[0], np.cumsum(count[leaf])])
        self.leaves, self.tail = len(leaf), count[len(head.cls) :]
        self.place = np.argsort(leaf).astype(np.int32)
        self.sorted = self.against = None  # found when first used, so that less is sent
        self.up, self.depth, level = np.full(2 * len(leaf), -1, np.int32), np.zeros(len(leaf), np.uint8), 0
        base, nodes = [], 0
        lo = np.searchsorted(cls[leaf], np.arange(CLASSES))
        hi, above = np.append(lo[1:], len(leaf)), np.full(CLASSES, -1)
        while True:
            one = hi - lo == 1
            self.up[leaf[lo[one]]], self.depth[leaf[lo[one]]] = above[one], level
            lo, hi, above = lo[~one], hi[~one], above[~one]
            if not len(lo):
                break
            node = nodes + np.arange(len(lo))
            self.up[self.leaves + node] = above
            nodes += len(node)
            middle = np.clip(np.searchsorted(sums, (sums[lo] + sums[hi]) / 2), lo + 1, hi - 1)
            base.append(np.log((sums[hi] - sums[middle]) / (sums[middle] - sums[lo])))
            lo, hi, above = np.concatenate([lo, middle]), np.concatenate([middle, hi]), np.concatenate([2 * node, 2 * node + 1])
            level += 1
        self.base = np.concatenate([*base, np.zeros(0)]).astype(np.float32)

    def leaf(self, at: np.ndarray, cls: np.ndarray) -> np.ndarray:
        return np.where(at >= 0, at, self.leaves - CLASSES + cls)

    def ways(self, leaf: np.ndarray):
        """The tokens in an order of falling depth, and for each step on the ways from their leaves up to their classes the up of the first tokens in that order, which have as many."""
        if self.against is None:
            self.against = np.stack([self.base, -self.base], axis=1).ravel()
        depth = np.take(self.depth, leaf)
        order = np.argsort(np.uint8(255) - depth, kind="stable")
        longer = len(leaf) - np.cumsum(np.bincount(depth, minlength=1))

        def steps():
            at = np.take(leaf, order)
            for m in longer[:-1].tolist():
                up = np.take(self.up, at[:m])
                yield up
                at = self.leaves + (up >> 1)

        return order, steps()

    def leaves_in_order(self) -> np.ndarray:
        if self.sorted is None:
            self.sorted = np.argsort(self.place)
        return self.sorted

    def pulls(self, keys: np.ndarray, shift: np.uint32, out: np.ndarray) -> None:
        """Adds what the counts alone lack of each side taken to the sum for that side of its feature's bucket. keys: place and word before (32 bits each), sorted here: pairs of words recur.

        out: two sums a bucket, left and right.
        """
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        times, keys = np.diff(first, append=len(keys)).astype(np.float64), keys[first]
        odds = np.exp(np.stack([self.base, -self.base], axis=1).ravel())
        lack = (odds / (odds + 1)).astype(np.float64)  # of 24 bits, so that sums are shorter to hand on
        for i in range(0, len(keys), WIDE):
            order, steps = self.ways(np.take(self.leaves_in_order(), (keys[i : i + WIDE] >> U64(32)).astype(np.int64)))
            words, n = np.take(keys[i : i + WIDE].astype(np.uint32), order), np.take(times[i : i + WIDE], order)
            for up in steps:
                on = bucket(words[: len(up)], up, shift)
                on <<= 1
                on += up & 1
                np.add.at(out, on, n[: len(up)] * np.take(lack, up))


def bucket(words: np.ndarray, up: np.ndarray, shift: np.uint32) -> np.ndarray:
    """The bucket of a split along with a word before."""
    h = (up >> 1).view(np.uint32) * NODE
    h += words
    h >>= shift
    return h.astype(np.int64)


class SplitWeights:
    """table: a weight for the right side, by the hash of node and words before (features of SEEN). A split's probability is logistic in their sum."""

    def __init__(self, splits: Splits, table: np.ndarray):
        self.splits, self.table = splits, table
        self.shift = np.uint32(33 - len(table).bit_length())

    def log_of(self, leaf: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """The logarithm of each leaf's probability in its class."""
        order, steps = self.splits.ways(leaf)
        short = [np.take(shortened(contexts[k]), order) for k in SEEN]
        inverse = np.ones(len(leaf))
        for up in steps:
            z = np.take(self.table, bucket(short[0][: len(up)], up, self.shift))
            for x in short[1:]:
                z += np.take(self.table, bucket(x[: len(up)], up, self.shift))
            z.view(np.uint32)[:] ^= up.view(np.uint32) << np.uint32(31)  # the other side's sign
            z += np.take(self.splits.against, up)
            np.exp(z, out=z)
            z += 1
            inverse[: len(up)] *= z
        out = np.empty(len(leaf))
        out[order] = -np.log(inverse)
        return out


def shortened(contexts: np.ndarray) -> np.ndarray:
    return (contexts >> U64(32)).astype(np.uint32)


def before(x: np.ndarray, first: np.ndarray, back: int, start) -> np.ndarray:
    """For every token, x of the token `back` places before it in its document, or `start`."""
    out = np.full(len(x), start, x.dtype)
    out[back:] = x[:-back]
    at = np.arange(len(x)) - np.repeat(first[:-1], np.diff(first))
    out[at < back] = start
    return out


def histories(symbols: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    """Hashes of the words before each token: KINDS by tokens."""
    w1, w2, w3 = (before(symbols, first, back, start).astype(np.uint64) for back in (1, 2, 3))
    return mix(np.stack([w1, w1 << U64(24) ^ w2 ^ U64(1 << 60), w2 ^ U64(2 << 60), w3 ^ U64(3 << 60)]) + U64(1))


def features(contexts: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of every token's features: tokens by KINDS."""
    return (contexts.T & U64(buckets - 1)).astype(np.int64)


def distinct(h: np.ndarray, c: np.ndarray | None, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each hash once, with the sum of its counts (None: of ones) and its ending."""
    coded = pa.array(h).dictionary_encode()
    back, u = coded.indices.to_numpy(), coded.dictionary.to_numpy()
    ending = np.empty(len(u), e.dtype)
    ending[back] = e
    return u, np.bincount(back, c, minlength=len(u)).astype(np.int64), ending


def vocabulary(docs: DataFrame) -> DataFrame:
    """h, c, e: the count and ending of every token of docs (column __x)."""

    def run(batches):
        held: list = []

        def merged():
            return distinct(*(np.concatenate(x) for x in zip(*held)))

        for _, buf, offs in chunks(batches, "__x"):
            h, e, _ = tokens(buf, offs)
            held.append(distinct(h, None, e))
            if sum(len(x[0]) for x in held) > 1_000_000:
                held = [merged()]
                if len(held[0][0]) > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["h", "c", "e"])
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=["h", "c", "e"])

    return docs.select("__x").mapInArrow(run, "h long, c long, e long").groupBy("h").agg(F.sum("c").alias("c"), F.min("e").cast("int").alias("e"))


def block_sums(docs: DataFrame, make, total: int, kind=np.float64) -> np.ndarray | None:
    """The sum, over all tasks, of the matrix that make(batches) gives; between tasks its numbers are of this kind. total: tokens of docs.

    A task's matrix is as large whatever it read, so small parts are read by one task, up to TASK tokens or two tasks a core.

    It is added up in two exchanges, BLOCK matrix rows to a row: first those of each SALT-th part of the tasks, then all. What a task adds is streamed:
    it holds one sum for each of its blocks, however many tasks there were.
    """

    def run(batches):
        out = make(batches)
        if out is not None:
            for at in range(0, len(out), BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([at // BLOCK]), pa.array([out[at : at + BLOCK].astype(kind).tobytes()], pa.binary())], names=["block", "sums"])

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(x.as_buffer(), kind)
                held[block] = held[block] + part if block in held else part.astype(np.float64)
        for block, total in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([total.astype(kind).tobytes()], pa.binary())], names=["block", "sums"])

    kinds = "block long, sums binary"
    few = max(2 * docs.sparkSession.sparkContext.defaultParallelism, total // TASK)
    parts = docs.select("__x").coalesce(few).mapInArrow(run, kinds).withColumn("salt", F.spark_partition_id() % SALT)
    rows = parts.repartition("block", "salt").select("block", "sums").mapInArrow(add, kinds).repartition("block").mapInArrow(add, kinds).collect()  # the matrix
    return np.concatenate([np.frombuffer(r["sums"], kind) for r in sorted(rows, key=lambda r: r["block"])]) if rows else None


def coded(docs: DataFrame, shared) -> DataFrame:
    """__x: each document's tokens as 32-bit numbers, the place among the head words or -1 less the spelling, so that words are hashed and looked up once."""

    def run(batches):
        words = shared.value
        for rows, buf, offs in chunks(batches, "__x"):
            h, spelling, first = tokens(buf, offs)
            at = words.look(h)
            code = np.where(at >= 0, at, -1 - spelling).astype(np.int32)
            ends = pa.py_buffer((4 * first).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), rows.num_rows, [None, ends, pa.py_buffer(code)])], names=["__x"])

    return cut(docs.select("__x").mapInArrow(run, "__x binary"))


def company(docs: DataFrame, shared) -> np.ndarray | None:
    """For each core word, by rank: sums over its places of the signs of its document's, previous and next frequent words. docs: as `coded` gives them."""
    wide, edge, edge2 = sum(SIGNS), SIGNS[0], SIGNS[0] + SIGNS[1]

    def make(batches):
        head, out = shared.value, None
        for _, buf, offs in chunks(batches, "__x"):
            out = np.zeros((wide // 2, head.core), np.complex128) if out is None else out
            first = offs // 4
            rank = head.core_rank(np.maximum(buf.view(np.int32).astype(np.int64), -1))
            seen = np.where((rank >= 0) & (rank < COMPANY), rank, COMPANY)
            per_doc = np.add.reduceat(_signs[seen, :edge], first[:-1], axis=0) if len(first) > 1 else np.zeros((0, edge), np.float32)
            per_doc /= np.maximum(np.add.reduceat((seen < COMPANY).astype(np.int64), first[:-1]), 1)[:, None] if len(first) > 1 else 1
            per_doc = np.round(per_doc * GRAIN) / GRAIN
            of = np.repeat(np.arange(len(first) - 1), np.diff(first))
            previous = before(seen, first, 1, COMPANY)
            following = np.concatenate([seen[1:], [COMPANY]])
            following[first[1:] - 1] = COMPANY
            own = np.flatnonzero(rank >= 0)
            for x, at, to in ((per_doc, of[own], 0), (_signs[:, edge:edge2], previous[own], edge), (_signs[:, edge2:], following[own], edge2)):
                pairs = np.ascontiguousarray(x).view(np.complex64).astype(np.complex128).T.copy()
                for j, pair in enumerate(pairs):  # two numbers at a time, as the parts of complex ones
                    np.add.at(out[to // 2 + j], rank[own], pair[at])
        return None if out is None else np.ascontiguousarray(out.T).view(np.float64)

    got = block_sums(docs, make, shared.value.total)
    return None if got is None else got.reshape(-1, wide)


def clusters(x: np.ndarray, counts: np.ndarray, k: int, steps: int = 12, seed: int = 17) -> np.ndarray:
    """k-means of the words' mean company, words weighed by the roots of their counts; rare words' means are drawn towards the common one."""
    x = x / np.maximum(counts, 1)[:, None]
    x = (x - np.average(x, axis=0, weights=counts)) * (counts / (counts + 4))[:, None]
    weight = np.sqrt(counts)
    rng = np.random.Generator(np.random.PCG64(seed))
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False, p=weight / weight.sum())]
    for _ in range(steps):
        far = (centre * centre).sum(axis=1)[None] - 2 * np.einsum("ij,kj->ik", x, centre)
        own = far.argmin(axis=1)
        mass = np.bincount(own, weight, minlength=len(centre))
        sums = np.stack([np.bincount(own, weight * x[:, j], minlength=len(centre)) for j in range(x.shape[1])], axis=1)
        centre = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-9)[:, None], centre)
    return own


class Weights:
    """bias: classes; table: buckets by classes. A table's numbers are too small for the products of a token's exponentials to leave float32's range."""

    def __init__(self, bias: np.ndarray, table: np.ndarray, within=None):
        self.bias, self.table, self.within = bias, table, within
        self.factors = None  # found by the first product: an exponential for each weight, not for each token

    def products(self, on: np.ndarray) -> np.ndarray:
        """The exponentials of the weights' sums: tokens by classes."""
        if self.factors is None:
            self.factors = np.exp(self.table + self.bias / np.float32(KINDS))
        z = np.take(self.factors, on[:, 0], axis=0, mode="clip")
        other = np.empty_like(z)
        for k in range(1, on.shape[1]):
            z *= np.take(self.factors, on[:, k], axis=0, out=other, mode="clip")
        return z

    def softmax(self, on: np.ndarray) -> np.ndarray:
        """Tokens by classes."""
        z = self.products(on)
        z *= (1 / (z @ ONES))[:, None]
        return z

    def log_of(self, on: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """The logarithm of each token's probability of its class."""
        z = self.products(on)
        return np.log(z[np.arange(len(cls)), cls] / (z @ ONES))


def met(on: np.ndarray, softmax, out: np.ndarray) -> None:
    """Adds softmax(on) of each token to every bucket it is in. out: pairs of classes, as complex numbers, by buckets: one addition serves two classes.

    A pair's row is worked on for all kinds in turn, so that it stays in the processor's cache.
    """
    pairs = np.empty((len(out), len(on)), np.complex64)
    for i in range(0, len(on), BATCH):
        pairs[:, i : i + BATCH] = softmax(on[i : i + BATCH]).view(np.complex64).T
    kinds = np.ascontiguousarray(on.T)
    for row, pair in zip(out, pairs):
        for flat in kinds:
            np.add.at(row, flat, pair)


def train(docs: DataFrame, shared, buckets: int, rounds: int = 2, splits: Splits | None = None, codes: DataFrame | None = None) -> Weights:
    """splits: the weights within classes are fitted too, from the pulls on them that the first pass adds up. codes: docs as `coded` gives them, if at hand."""
    cells = SPLIT_BUCKETS * buckets
    docs = coded(docs, shared) if codes is None else codes

    def passed(add, kind=np.float64, inside=None) -> np.ndarray | None:
        """The sums, over all tokens, of what add(buckets, classes, out) puts into out; below them, if `inside` (broadcast splits) is given, the pulls on its weights."""

        def make(batches):
            words, out, pulls, waiting, size = shared.value, None, None, [], 0
            shift = np.uint32(33 - cells.bit_length())

            def pulled():
                for keys in zip(*waiting):
                    inside.value.pulls(np.concatenate(keys), shift, pulls)
                waiting.clear()

            for _, buf, offs in chunks(batches, "__x"):
                if out is None:
                    out, pulls = np.zeros((CLASSES, buckets)), np.zeros(2 * cells if inside else 0)
                code, first = buf.view(np.int32).astype(np.int64), offs // 4
                at = np.maximum(code, -1)
                cls = words.classes(at, np.maximum(-1 - code, 0))
                contexts = histories(words.symbols(at, cls), first, words.start)
                add(features(contexts, buckets), cls, out)
                if inside:
                    place = np.take(inside.value.place, inside.value.leaf(at, cls)).astype(np.uint64) << U64(32)
                    waiting.append([place | contexts[k] >> U64(32) for k in SEEN])
                    size += len(code)
                    if size >= PAIRS:
                        pulled()
                        size = 0
            if waiting:
                pulled()
            return None if out is None else np.concatenate([out.T, pulls.reshape(-1, CLASSES)])

        got = block_sums(docs, make, shared.value.total, kind)
        return None if got is None else got.astype(np.float64).reshape(-1, CLASSES)

    mass = shared.value.mass
    bias = np.log(mass).astype(np.float32)
    within = SplitWeights(splits, np.zeros(cells, np.float32)) if splits else None
    inside = docs.sparkSession.sparkContext.broadcast(splits) if splits else None
    seen = passed(lambda on, cls, out: np.add.at(out.reshape(-1), (on + buckets * cls[:, None]).ravel(), 1.0), inside=inside)
    if inside:
        inside.destroy()
    if seen is None:
        return Weights(bias, np.zeros((buckets, CLASSES), np.float32), within)
    seen, pulls = seen[:buckets], seen[buckets:].reshape(-1, 2)
    if splits:
        within = SplitWeights(splits, (SPLIT_START * np.log((pulls[:, 1] + PULL) / (pulls[:, 0] + PULL))).astype(np.float32))
    table = START * (np.log((seen + PRIOR * mass) / (seen.sum(axis=1, keepdims=True) + PRIOR)) - np.log(mass))
    for _ in range(rounds):
        start = docs.sparkSession.sparkContext.broadcast(Weights(bias, table.astype(np.float32)))

        def expect(on, cls, out, start=start):
            sums = np.zeros((CLASSES // 2, buckets), np.complex64)  # of one chunk, so that float32 is enough
            for i in range(0, len(on), 4 * BATCH):
                met(on[i : i + 4 * BATCH], start.value.softmax, sums)
            out[::2] += sums.real
            out[1::2] += sums.imag

        expected = passed(expect, np.float32)
        start.destroy()
        table += (seen - expected) / (KINDS / 4 * (seen + expected) + PRIOR)
    return Weights(bias, table.astype(np.float32), within)


def learned(training: DataFrame, head: int, core: int, classes: bool = True):
    """The head words (broadcast), classified if the model needs it, the counts of all others, and then the training texts coded. training: __x."""
    sc = training.sparkSession.sparkContext
    counts = cut(vocabulary(training))
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = [c.to_numpy() for c in counts.orderBy(F.desc("c"), "h").limit(head).select("h", "c", "e").toArrow().columns]  # at most `head` rows
    edge = (F.col("c") < int(top[1][-1])) | ((F.col("c") == int(top[1][-1])) & (F.col("h") > int(top[0][-1]))) if len(top[0]) else F.lit(True)
    rest = counts.where(edge)
    known = Head(*top, total, kinds, core)
    shared = sc.broadcast(known)
    if not classes:
        return shared, rest, None
    tail = [(r["e"], r["n"], r["v"]) for r in rest.groupBy("e").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()]  # at most SPELLINGS rows
    codes = coded(training, shared)
    of_core = np.minimum(np.arange(known.core), ALONE)
    if known.core > ALONE:
        signs = company(codes, shared)
        by_rank = top[1][: known.core].astype(np.float64)
        of_core[ALONE:] = ALONE + clusters(signs[ALONE:].astype(np.float64), by_rank[ALONE:], CLASSES - ALONE)
    known = Head(*top, total, kinds, core)
    known.classify(of_core, tail)
    return sc.broadcast(known), rest, codes


def learn_head(training: DataFrame, head: int, core: int, classes: bool = True):
    """The head words and the counts of all others, as `learned` has them."""
    return learned(training, head, core, classes)[:2]


def score(docs: DataFrame, learn: Column, id: str = "doc_id", text: str = "text", head: int = 1 << 18, core: int = 1 << 15, rounds: int = 2, keep: tuple[str, ...] = (), model: bool = True, within: bool = False) -> DataFrame:
    """doc_id, the columns of `keep` (of one value for an id), n_tokens, n_known, train_tokens, base_score, score of every document.

    within: the words before a token also choose it within its class, by splits; else a class's words are told apart by their counts only.
    Without `model` there is no score, and nothing is trained: the counts and the base score need the vocabulary only.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    own = docs.withColumns({"__k": F.xxhash64(F.lit(1), F.col(id)), "__t": F.xxhash64(F.col(text).cast("string")), "__x": F.col(text).cast("string")})
    own = own.select("__k", "__t", F.col(id).alias("doc_id"), *keep, "__x", learn.alias("__learn"))
    training = own.where("__learn").select("__x")
    shared, rest, codes = learned(training, head, core, classes=model)
    total, kinds = shared.value.total, shared.value.kinds
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << int(max(1, kinds) - 1).bit_length()))
    splits = Splits(shared.value) if model and within else None
    trained = spark.sparkContext.broadcast(train(training, shared, buckets, rounds, splits, codes) if model else None)
    extra = [f for f in own.schema.fields if f.name in ("doc_id", *keep)]
    names = ["__k", "__t", *(f.name for f in extra), "rows", "n_tokens", "known", "base", "model", "h", "tf"]

    def run(batches):
        words, w = shared.value, trained.value
        log_head = np.log10(words.counts + 0.5)
        if w:
            log_in = np.log10(words.counts) - np.log10(words.size[words.cls])
            log_size = np.log10(words.size)
        keys = U64(1)
        for rows, buf, offs in chunks(batches, "__x"):
            h, spelling, first = tokens(buf, offs)
            at = words.look(h)
            in_head, p = at >= 0, np.zeros(len(h))
            if w:
                cls = words.classes(at, spelling)
                contexts = histories(words.symbols(at, cls), first, words.start)
                on = features(contexts, buckets)
                p = np.concatenate([w.log_of(on[i : i + BATCH], cls[i : i + BATCH]) for i in range(0, max(1, len(cls)), BATCH)]).astype(np.float64) / np.log(10)
                if within:
                    inside, leaf = w.within, w.within.splits.leaf(at, cls)
                    p += np.concatenate([inside.log_of(leaf[i : i + WIDE], contexts[:, i : i + WIDE]) for i in range(0, max(1, len(cls)), WIDE)]) / np.log(10)
                    p -= np.where(in_head, 0.0, np.log10(inside.splits.tail)[cls])
                else:
                    p += np.where(in_head, log_in[at], -log_size[cls]) if len(words.h) else -log_size[cls]
            base = np.where(in_head, log_head[at], 0) if len(words.h) else np.zeros(len(h))
            per = lambda x: np.add.reduceat(x, first[:-1]) if len(first) > 1 else x[:0]  # noqa: E731  every document has its end
            n = rows.num_rows
            doc = np.repeat(np.arange(n), np.diff(first))[~in_head]
            rare = h[~in_head]
            _, lead, tf = np.unique(rare.view(np.uint64) ^ mix(doc.astype(np.uint64) + U64(1)), return_index=True, return_counts=True)
            columns = [rows.column(0), rows.column(1), *rows.columns[2 : 2 + len(extra)], pa.array(np.ones(n, np.int64)), pa.array(np.diff(first).astype(np.int64)), pa.array(per(in_head.astype(np.int64))), pa.array(per(base)), pa.array(per(p)), pa.array(mix(np.arange(n, dtype=np.uint64) + keys).view(np.int64)), pa.array(np.zeros(n, np.int64))]
            keys += U64(n)
            yield pa.RecordBatch.from_arrays(columns, names=names)
            of, m = pa.array(doc[lead]), len(lead)
            columns = [rows.column(0).take(of), rows.column(1).take(of), *(pa.nulls(m, c.type) for c in rows.columns[2 : 2 + len(extra)]), *(pa.nulls(m, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())), pa.array(rare[lead]), pa.array(tf.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds_of = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in extra)
    parts = own.select("__k", "__t", *(f.name for f in extra), "__x").mapInArrow(run, f"__k long, __t long, {kinds_of}rows long, n_tokens long, known long, base double, model double, h long, tf long")
    # A document's own row takes part in the look-up under a key that no word has in practice, with a count of 0: one pass gives both.
    found = parts.join(rest.select("h", "c"), "h", "left")
    rare = F.sum(F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare")
    rare_known = F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("rare_known")
    both = found.groupBy("__k", "__t").agg(*(F.sum(c).alias(c) for c in ("rows", "n_tokens", "known", "base", "model")), *(F.max(f.name).alias(f.name) for f in extra), rare, rare_known)
    denominator = float(np.log10(total + 0.5 * (kinds + 1)))
    m = F.col("rows")
    return both.withColumn("__each", F.explode(F.sequence(F.lit(1).cast("long"), m))).select(
        "doc_id", *keep, (F.col("n_tokens") / m).cast("long").alias("n_tokens"), ((F.col("known") + F.col("rare_known")) / m).cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        ((F.col("base") + F.col("rare") - F.col("n_tokens") * denominator) / m).alias("base_score"), *([((F.col("model") + F.col("rare")) / m).alias("score")] if model else []),
    )
