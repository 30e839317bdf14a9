"""Spelling variants: near words by search schemes on a bidirectional FM-index over the delimited vocabulary.

Words: maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased, of `least` code points or more that occur twice or more. For tests of the
grouping, and as the query's contract has it, one run of 31 (by CRC-32 of `id:run`) loses a code point first. Two words are near if they differ by
exactly one inserted, deleted or replaced code point. A word's form is its near word of largest count (ties: least in code-point order), if that count is
ten times its own or more; its root is where the forms end.

Search scheme: of two near words, one's first or second half stands unchanged at the other's start or end. So a word matches one half exactly and
extends across the other, allowing one error. The index holds the vocabulary twice, for both directions, with delimiters between words: a state is an interval of
suffix ranks, and one step maps it by the last-to-first mapping. All words of an index take their steps together, as arrays.

Partition: a word goes to two groups, by its first 3 and its last 4 code points (the halves of the shortest words), so near words meet in
one of these. A task builds an index over the whole groups that it holds, a few MB at a time. Groups over `tile` words are dealt out: each word is indexed in one
tile and searched in all of them. A word gets a count and its best near word from each group, never the list of pairs.

Defined results: null text has no words; a null id counts as an empty text in the hash; repeated rows count as often as they stand. Any length of
text or word works; texts are split into runs piece by piece. Words of equal counts are each other's near words but no forms. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bounded_batches, chunks, cut, whole_groups

#: Words that a task counts before it hands them on, and code points of text that are split at once.
HELD_WORDS, PIECE = 1 << 18, 1 << 22
#: Bytes of groups that are indexed together.
INDEX_BYTES = 1 << 22
#: Intervals up to this size are read symbol by symbol, larger ones are tried with the whole alphabet.
NARROW = 24


def vocabulary(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 7, drop: int = 31) -> DataFrame:
    """word, n: the words that occur twice or more. One run of `drop` loses a code point; 0: none does."""
    bounded_batches(docs.sparkSession)
    own = docs.select(F.coalesce(docs[id].cast("string"), F.lit("")).alias("id"), docs[text].cast("string").alias("x"))
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def counted(batches):
        held: Counter[str] = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for rows, buf, offs in chunks(batches, "x"):
            ids = rows.column(0).to_pylist()
            lower = LOWER[buf].tobytes()
            for i, key in enumerate(ids):
                x = lower[offs[i] : offs[i + 1]].decode("utf-8", "replace")
                start = zlib.crc32(f"{key}:".encode())
                found = runs.findall(x) if len(x) <= PIECE else (m.group() for m in runs.finditer(x))
                for word, n in Counter(found).items():
                    h = zlib.crc32(word.encode(), start)
                    if drop and h % drop == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return own.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n >= 2")


class Index:
    """One direction of the FM-index: words (as Latin-1 bytes), each ended by a delimiter of value 0; equal suffixes are ordered by word."""

    def __init__(self, words: list[bytes]):
        lens = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        n = len(text)
        ends = np.cumsum(lens + 1) - 1
        word = np.repeat(np.arange(len(words)), lens + 1)
        left = ends[word] - np.arange(n)
        rank, width = text.astype(np.int64), 1
        while width <= int(lens.max(initial=0)):
            later = np.zeros(n, np.int64)
            later[:-width] = rank[width:] + 1
            later[left < width] = 0
            _, rank = np.unique(rank * (n + 257) + later, return_inverse=True)
            width *= 2
        order = np.argsort(rank * len(words) + word, kind="stable")
        before = np.where(order > 0, text[order - 1], 0)
        before[left[order] == lens[word[order]]] = 0
        self.n, self.count, self.word, self.before = n, len(words), word[order], before
        self.keys = np.sort(before.astype(np.int64) * n + np.arange(n))
        self.alphabet = np.unique(before[before > 0])

    def step(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the suffixes with the symbol put before them."""
        at = symbol.astype(np.int64) * self.n
        return np.searchsorted(self.keys, at + lo), np.searchsorted(self.keys, at + hi)

    def whole(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For which intervals a whole word begins there, and that word."""
        a, b = self.step(lo, hi, np.zeros(len(lo), np.int64))
        hit = np.flatnonzero(b > a)
        return hit, self.word[self.keys[a[hit]]]

    def symbols(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every symbol that may stand before each interval: its number, the symbol."""
        size = hi - lo
        narrow, wide = np.flatnonzero(size <= NARROW), np.flatnonzero(size > NARROW)
        own = np.repeat(narrow, size[narrow])
        ends = np.cumsum(size[narrow])
        rows = np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo[narrow] - ends + size[narrow], size[narrow])
        code = np.unique(own * 256 + self.before[rows])
        code = code[code % 256 > 0]
        k = len(self.alphabet)
        return np.concatenate([code // 256, np.repeat(wide, k)]), np.concatenate([code % 256, np.tile(self.alphabet, len(wide))])


def one_error(index: Index, patterns: list[bytes], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, word) pairs, distinct: words that differ from a pattern by one edit and agree with its last `exact` symbols."""
    lens = np.fromiter(map(len, patterns), np.int64, len(patterns))
    flat = np.frombuffer(b"".join(patterns), np.uint8)
    last = np.cumsum(lens) - 1
    own = np.arange(len(patterns))
    lo, hi = np.zeros(len(own), np.int64), np.full(len(own), index.count)
    none = np.zeros(0, np.int64)
    erred, a, b = none, none, none
    found = []
    depth = 0
    while len(own) or len(erred):
        ready = np.flatnonzero(exact[own] <= depth)
        which, symbol = index.symbols(lo[ready], hi[ready])
        which = ready[which]
        x, y = index.step(lo[which], hi[which], symbol)
        some = y > x
        which, symbol, x, y = which[some], symbol[some], x[some], y[some]
        more = lens[own[which]] > depth
        other = more.copy()
        other[more] = flat[last[own[which[more]]] - depth] != symbol[more]
        # An inserted symbol leaves the depth, a replaced or deleted one moves on.
        erred, a, b = np.concatenate([erred, own[which]]), np.concatenate([a, x]), np.concatenate([b, y])
        moved, c, d = own[which[other]], x[other], y[other]
        less = ready[lens[own[ready]] > depth]
        moved, c, d = np.concatenate([moved, own[less]]), np.concatenate([c, lo[less]]), np.concatenate([d, hi[less]])
        done = lens[erred] == depth
        hit, word = index.whole(a[done], b[done])
        found.append(erred[done][hit] * index.count + word)
        erred, a, b = erred[~done], a[~done], b[~done]
        a, b = index.step(a, b, flat[last[erred] - depth])
        on = b > a
        erred, a, b = np.concatenate([erred[on], moved]), np.concatenate([a[on], c]), np.concatenate([b[on], d])
        on = lens[own] > depth
        own, lo, hi = own[on], lo[on], hi[on]
        lo, hi = index.step(lo, hi, flat[last[own] - depth])
        on = hi > lo
        own, lo, hi = own[on], lo[on], hi[on]
        depth += 1
    pairs = np.unique(np.concatenate(found)) if found else none
    return pairs // max(index.count, 1), pairs % max(index.count, 1)


def best_of(table: pa.Table):
    """word, near, best_n, best of each row that finds near words in its own group. table: g, word, n, tail (is the last half's group), own (is indexed here)."""
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    g, n, tail, own = (table.column(c).to_numpy() for c in ("g", "n", "tail", "own"))
    known, place = np.unique(np.array(words, object), return_inverse=True)
    known = known.tolist()
    counts = np.zeros(len(known), np.int64)
    counts[place] = n
    _, group = np.unique(g, return_inverse=True)
    indexed = np.unique(group[own] * len(known) + place[own])
    used = np.unique(place[own])
    if not len(used):
        return
    rows, others = [], []
    for at_end in (False, True):
        asked = np.flatnonzero(tail == at_end)
        turn = (lambda w: w) if at_end else (lambda w: w[::-1])
        index = Index([turn(known[i]) for i in used])
        size = np.fromiter((len(words[i]) for i in asked), np.int64, len(asked))
        a, b = one_error(index, [turn(words[i]) for i in asked], size - size // 2 if at_end else size // 2)
        a, b = asked[a], used[b]
        here = np.isin(group[a] * len(known) + b, indexed)
        a, b = a[here], b[here]
        if at_end:  # the first half's group has these already
            new = np.fromiter((not known[y].startswith(words[x][: len(words[x]) // 2]) for x, y in zip(a.tolist(), b.tolist())), bool, len(a))
            a, b = a[new], b[new]
        rows.append(a)
        others.append(b)
    a, b = np.concatenate(rows), np.concatenate(others)
    order = np.lexsort((b, -counts[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, int)
    near = np.diff(np.concatenate([first, [len(a)]])) if len(a) else first
    yield pa.RecordBatch.from_arrays(
        [table.column("word").combine_chunks().take(pa.array(a[first])), pa.array(near.astype(np.int64)), pa.array(counts[b[first]]), pa.array([known[i].decode("latin-1") for i in b[first].tolist()], pa.string())], names=["word", "near", "best_n", "best"]
    )


def near_words(words: DataFrame, tile: int = 1 << 16) -> DataFrame:
    """word, n, n_near, best_n, best (the near word of largest count) of every word. words: word, n; words of 7 code points at least."""
    ends = F.array(F.struct(F.lit(False).alias("tail"), F.substring("word", 1, 3).alias("end")), F.struct(F.lit(True).alias("tail"), F.substring("word", -4, 4).alias("end")))
    rows = words.select("word", "n", F.explode(ends).alias("k")).select("word", "n", "k.*")
    large = rows.groupBy("tail", "end").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles")).where("tiles > 1")
    dealt = rows.join(large, ["tail", "end"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select(F.xxhash64("tail", "end", "at").alias("g"), "word", "n", "tail", (F.pmod(F.xxhash64("word"), F.col("tiles")) == F.col("at")).alias("own"))
    found = whole_groups(dealt, best_of, "word string, near long, best_n long, best string", INDEX_BYTES)
    got = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b"))
    return words.join(got, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), (-F.col("b.n")).alias("best_n"), "b.best")


def group(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 7, drop: int = 31, times: int = 10, tile: int = 1 << 16) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    if least < 7:
        raise ValueError("halves of words under 7 code points are shorter than the groups' keys")
    words = cut(vocabulary(docs, id, text, least, drop))
    is_form = F.col("best_n") >= times * F.col("n")
    near = cut(near_words(words, tile).select("word", "n", "n_near", F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")))
    # Counts grow tenfold with every form, so chains are short; each round doubles what a root skips.
    roots = near.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = cut(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = after.drop("moved")
        if after.where("moved").isEmpty():
            break
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
