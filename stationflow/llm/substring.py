"""Repeated passages, found by seed and extend.

A window is `window` consecutive words. Every window has one anchor: of its k-grams the one with the least hash, the
rightmost of equals. The choice depends on the window's words alone, so two equal windows have equal anchors at the
same place, and joining documents on anchors loses no repeat. Each anchor occurrence is extended both ways to its span: the words of
all windows that it anchors.
- An anchor that occurs once anchors no repeat.
- If all occurrences of an anchor have the same span, the whole span repeats.
- Otherwise, one occurrence of each distinct span is extended window by window; windows that belong to two distinct spans repeat,
  and a span that occurs twice repeats whole.
Overlapping repeated windows of a document join up to its maximal repeats over the length threshold.

No pair of occurrences is ever formed: counts are partial aggregates by anchor, span and window hash, so a passage
that a third of all documents share costs one row for each distinct neighbourhood. The places of the most frequent anchors and spans
are settled where they are read, from a table of bounded size, and take part in no join.

Equality is that of 128 bits of hashes (64 of the anchor, 64 of the span or window). Defined results: null, empty and short
texts have no window; repeated rows repeat each other, as any two copies do; a text may repeat itself. An empty table gives no rows.
Other columns are passed on by remove() and ignored by measure(). Long texts are handled whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, bounded_batches, chunks, cut, gram_hashes, mix, powers

U64 = np.uint64
#: Keys that are told to all tasks at most, and places from which a key may be one of them.
HOT_KEYS, HOT_PLACES = 4096, 1000
_WINDOW_BASE, _SPAN_BASE = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    have = 1
    while 2 * have <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    return np.minimum(v[: len(v) - (width - have)], v[width - have :]) if width > have else v


def anchors(words: Words, window: int, k: int) -> tuple[np.ndarray, ...]:
    """document, word position, words back to the first and last window start, anchor hash, span hash: one of each for every anchor occurrence."""
    empty = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    h = words.hashes()
    if len(h) < window:
        return empty
    counts = words.counts
    per = np.maximum(counts - window + 1, 0)
    if not per.any():
        return empty
    doc = np.repeat(np.arange(len(per)), per)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per - words.first[:-1], per)
    grams = gram_hashes(h, k)
    rank = (grams >> U64(32) << U64(32)) | (U64(0xFFFFFFFF) - np.arange(len(grams), dtype=np.uint64))
    chosen = (U64(0xFFFFFFFF) - (sliding_min(rank, window - k + 1)[start] & U64(0xFFFFFFFF))).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])]))
    last = np.concatenate([new[1:], [len(doc)]]) - 1
    at, a, b = chosen[new], start[new], start[last]
    up, down = powers(len(h) + 1, _SPAN_BASE)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=sums[1:])
    shape = ((at - a) * 4096 + (at - b)).astype(np.uint64)
    span = mix(((sums[b + window] - sums[a]) * down[a]) ^ mix(shape + U64(1)))
    return doc[new], at - words.first[doc[new]], at - a, at - b, grams[at], span


class Held:
    """A set of pairs of 64-bit numbers."""

    def __init__(self, pairs: list[tuple[int, int]]):
        a, b = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        order = np.argsort(self.key(a, b), kind="stable")
        self.a, self.b, self.keys = a[order], b[order], self.key(a, b)[order]

    @staticmethod
    def key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix(a.view(np.uint64)) ^ b.view(np.uint64)

    def holds(self, a: np.ndarray, b: np.ndarray | None = None) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(a), bool)
        b = np.zeros(len(a), np.int64) if b is None else b
        at = np.minimum(np.searchsorted(self.keys, self.key(a, b)), len(self.keys) - 1)
        return (self.a[at] == a) & (self.b[at] == b)


def keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """__k, __t: the key of a row (equal rows share it)."""
    return docs.withColumns({"__k": F.xxhash64(F.lit(1), F.col(id)), "__t": F.xxhash64(F.col(text).cast("string"))})


def marks(own: DataFrame, window: int = 35, k: int = 8) -> DataFrame:
    """__k, __t, m: for each document with a repeat, its places as (p, bits): the windows that start o words before p repeat, for each bit o.

    own: the documents with __k, __t, __x (text). They are shuffled by key as they are, so that a join of the same rows with
    the result shares the exchange: texts are written once. window - k must be under 63.
    """
    bounded_batches(own.sparkSession)
    low = window - k + 1
    assert 0 < low < 63, "the anchor must leave under 63 window starts"

    def find(batches):
        for rows, buf, offs in chunks(batches, "__x"):
            doc, p, a, b, ah, sh = anchors(Words(buf, offs), window, k)
            first = np.searchsorted(doc, np.arange(len(offs)))
            data = np.stack([(p << 12 | a << 6 | b), ah.view(np.int64), sh.view(np.int64)], axis=1).tobytes()
            blob = pa.Array.from_buffers(pa.binary(), rows.num_rows, [None, pa.py_buffer((24 * first).astype(np.int32)), pa.py_buffer(data)])
            has = pa.array(first[1:] > first[:-1])
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), blob], names=["__k", "__t", "blob"]).filter(has)

    found = cut(own.select("__k", "__t", "__x").mapInArrow(find, "__k long, __t long, blob binary"))

    def opened(batches):
        """key, text hash, place, anchor and span of every anchor occurrence, as arrays, and which row of the batch each is of."""
        for batch in batches:
            blob = batch.column(2)
            offs = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1]
            data = np.frombuffer(blob.buffers()[2] or b"", np.uint8)[offs[0] : offs[-1]].view(np.int64).reshape(-1, 3)
            yield batch, np.repeat(np.arange(len(blob)), np.diff(offs) // 24), *(np.ascontiguousarray(data[:, i]) for i in range(3))

    def light(batches):
        for _, _, _, ah, sh in opened(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ah), pa.array(sh)], names=["ah", "sh"])

    def chosen(which):
        """Place rows where which(ah, sh) says so: it gives the rows, and of these, whether the place is settled (then ah and sh are null)."""

        def run(batches):
            for batch, of, p, ah, sh in opened(batches):
                rows, settled = which(ah, sh)
                of = pa.array(of[rows])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), pa.array(p[rows]), pa.array(ah[rows], mask=settled), pa.array(sh[rows], mask=settled)], names=["__k", "__t", "p", "ah", "sh"])

        return found.mapInArrow(run, "__k long, __t long, p long, ah long, sh long")

    # Anchors that occur twice or more; `mixed` ones have distinct spans.
    seeds = cut(found.mapInArrow(light, "ah long, sh long").groupBy("ah").agg(F.count("*").alias("n"), F.min("sh").alias("x"), F.max("sh").alias("y")).where("n > 1").select("ah", "n", (F.col("x") != F.col("y")).alias("mixed")))

    # The most frequent anchors, and their most frequent spans, are told to the tasks: at most HOT_KEYS rows each, so no join meets a key
    # with more than one HOT_KEYS-th of all places. All others are joined.
    hottest = lambda df: df.where(F.col("n") >= HOT_PLACES).orderBy(F.desc("n"), *(c for c in ("ah", "sh") if c in df.columns)).limit(HOT_KEYS)
    top = hottest(seeds).collect()
    hot = Held([(r["ah"], 0) for r in top])
    mixed = Held([(r["ah"], 0) for r in top if r["mixed"]])
    one = lambda df: df.groupBy("ah", "sh").agg(F.count("*").alias("n"), F.min(F.struct("__k", "__t", "p")).alias("at"))
    unsettled = lambda rows: (np.flatnonzero(rows), np.zeros(int(rows.sum()), bool))
    places = chosen(lambda ah, sh: unsettled(~hot.holds(ah))).join(seeds, "ah")
    places = places.select("__k", "__t", "p", F.when(F.col("mixed"), F.col("ah")).alias("ah"), F.when(F.col("mixed"), F.col("sh")).alias("sh"))
    if top:
        hot_spans = cut(one(chosen(lambda ah, sh: unsettled(mixed.holds(ah)))))
        told = Held([(r["ah"], r["sh"]) for r in hottest(hot_spans).select("ah", "sh").collect()])
        places = places.unionByName(chosen(lambda ah, sh: (rows := np.flatnonzero(hot.holds(ah)), ~mixed.holds(ah[rows]) | told.holds(ah[rows], sh[rows]))))
    places = cut(places)
    whole = F.expr("shiftleft(2L, cast(shiftright(p, 6) & 63 as int)) - shiftleft(1L, cast(p & 63 as int))")

    # Distinct spans of mixed anchors, each with one place, whose windows are compared.
    spans = one(places.where("ah is not null"))
    if top:
        kept = spans.join(hot_spans.select("ah", "sh"), ["ah", "sh"], "left_anti")
        spans = kept.unionByName(hot_spans)
    spans = cut(spans)
    wanted = spans.groupBy("at.__k", "at.__t").agg(F.collect_list(F.struct("at.p", "ah", "sh")).alias("r")).select("__k", "__t", F.col("r.p").alias("__p"), F.col("r.ah").alias("__ah"), F.col("r.sh").alias("__sh"))

    def expand(batches):
        for rows, buf, offs in chunks(batches, "__x"):
            words = Words(buf, offs)
            windows = gram_hashes(words.hashes(), window, _WINDOW_BASE)
            p, ah, sh = (rows.column(i) for i in ("__p", "__ah", "__sh"))
            at = np.diff(p.offsets.to_numpy())
            packed = p.flatten().to_numpy()
            place = np.repeat(words.first[:-1], at) + (packed >> 12)
            back, fore = packed >> 6 & 63, packed & 63
            n = back - fore + 1
            of = np.repeat(np.arange(len(n)), n)
            o = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + fore[of]
            yield pa.RecordBatch.from_arrays([ah.flatten().take(pa.array(of)), sh.flatten().take(pa.array(of)), pa.array(o.astype(np.int32)), pa.array(windows[place[of] - o].view(np.int64))], names=["ah", "sh", "o", "wh"])

    texts = own.join(wanted.hint("merge"), ["__k", "__t"])
    # A window counts as repeated if it starts at two (span, offset) pairs; the same pair met twice, by repeated rows, is one.
    rows = texts.mapInArrow(expand, "ah long, sh long, o int, wh long")
    own_start = F.xxhash64("sh", "o")
    twice = rows.groupBy("ah", "wh").agg(F.min(own_start).alias("x"), F.max(own_start).alias("y")).where("x <> y").select("ah", "wh")
    partly = rows.join(twice, ["ah", "wh"]).groupBy("ah", "sh").agg(F.bit_or(F.expr("shiftleft(1L, o)")).alias("bits"))
    known = spans.select("ah", "sh", "n").join(partly, ["ah", "sh"], "left").where("n > 1 or bits is not null")
    some = places.where("ah is not null").join(known, ["ah", "sh"]).select("__k", "__t", "p", F.when(F.col("n") > 1, whole).otherwise(F.col("bits")).alias("bits"))
    every = places.where("ah is null").select("__k", "__t", "p", whole.alias("bits"))
    return some.unionByName(every).groupBy("__k", "__t").agg(F.collect_set(F.struct(F.shiftright("p", 12).alias("p"), "bits")).alias("m"))


def covered(n: int, p: np.ndarray, bits: np.ndarray, window: int) -> np.ndarray:
    """Which of a document's n words a repeated window covers."""
    step = np.zeros(n + 1, np.int64)
    for o in range(63):
        s = p[(bits >> o & 1).astype(bool)] - o
        if len(s):
            np.add.at(step, s, 1)
            np.add.at(step, s + window, -1)
    return np.cumsum(step[:-1]) > 0


def _marked(docs: DataFrame, window: int, k: int, id: str, text: str) -> DataFrame:
    own = keyed(docs, id, text).withColumn("__x", F.col(text).cast("string"))
    own = own.select("__k", "__t", "__x", *(c for c in docs.columns if c != text))
    own = own.join(marks(own, window, k).hint("merge"), ["__k", "__t"], "left").withColumns({"__p": F.col("m.p"), "__b": F.col("m.bits")})
    return own.select(*(F.col("__x").alias(text) if c == text else c for c in docs.columns), "__p", "__b")


def _each(batch: pa.RecordBatch, window: int, text: str):
    """text bytes, words, cover (None if nothing repeats) of each row."""
    p, b = batch.column("__p"), batch.column("__b")
    for i, t in enumerate(batch.column(text)):
        t = (t.as_py() or "").encode()
        words = t.split()
        yield t, words, covered(len(words), p[i].values.to_numpy(), b[i].values.to_numpy(), window) if p[i].is_valid else None


def measure(docs: DataFrame, window: int = 35, k: int = 8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the words that stay, joined by one space) of every row."""
    own = docs.select(docs[id].alias("doc_id"), docs[text].cast("string").alias("text"))
    rows = _marked(own, window, k, "doc_id", "text")

    def run(batches):
        for batch in batches:
            out = []
            for _, words, cover in _each(batch, window, "text"):
                kept = words if cover is None else [w for w, c in zip(words, cover.tolist()) if not c]
                out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, removed, sha = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return rows.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string")


def remove(docs: DataFrame, window: int = 35, k: int = 8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with repeated words cut from the text, each with the white space before it; other texts stay as they are. Columns may have any names."""
    names = [f"own_{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)
    schema, docs, id, text = docs.schema, docs.toDF(*names), names[docs.columns.index(id)], names[at]
    rows = _marked(docs, window, k, id, text)

    def run(batches):
        for batch in batches:
            out = []
            for (t, words, cover), old in zip(_each(batch, window, text), batch.column(text)):
                if cover is None:
                    out.append(old.as_py())
                    continue
                w = Words(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
                edges = np.concatenate([[0], w.ends])
                parts = [t[edges[i] : edges[i + 1]] for i in np.flatnonzero(~cover).tolist()]
                out.append((b"".join(parts).strip() + t[edges[-1] :] if parts else b"").decode())
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
