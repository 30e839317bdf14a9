"""Phrase collocations: Misra-Gries summaries per hash partition find all phrases that can be frequent, a second pass counts these exactly.

Phrases: runs of 1 to `longest` words within a piece of a text (A-Z lower-cased; pieces end at punctuation and line ends), for each language by itself. A phrase of two or more words
with `least` occurrences is a candidate. Its score is the lowest, over its cuts in two, of floor(10^6 a^2 / (l r)), with exact counts a of the whole, l and r of the parts.

First pass: a phrase is hashed to one of P partitions and a cell within it. A task packs the counts of its cells for each partition; a partition's summaries are
merged by Misra-Gries: over its capacity of counters, all are lowered by the largest counter that has no place. The capacity is over ROOM times the partition's mass (all
occurrences in it) over `least`, so what is taken from any cell stays under least / ROOM and each cell that holds a frequent phrase is left, together with some that don't.
What is left becomes a bit filter of FILTER_BITS bits at most, its slices made by the partitions; it is all that comes to the driver.
Second pass: phrases that pass the filter are counted exactly, by their words. A task hands on its phrases sorted and compressed, in one block for each partition and language, and
the blocks of a partition's language are added up. Filters only save work: with a full one, every phrase is counted.

Number of partitions and cells follow the bytes of text, so a partition's share stays the same at every size. A frequent phrase is one row for each task, never a hot key.

Defined results: null text counts as empty, a null language as `und`. Texts without words add nothing. Repeated rows count as often as they stand. An
empty table gives no rows. Ties are ranked by count, then by the phrase's bytes. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, SPACE, U64, Words, bounded_batches, chunks, cut, gram_hashes, mix

ENDS = np.zeros(256, bool)
ENDS[list(b".,;:!?\n\v\f\r")] = True
APART = SPACE | ENDS
FILTER_BITS = 1 << 27
#: Occurrences that a partition holds about, cells of which a task keeps the counts, phrases that it keeps in the second pass (or more, if as many differ).
SHARE, HELD_CELLS, HELD_PHRASES = 1 << 21, 1 << 23, 1 << 20
#: The more room for counters, the fewer cells pass without being frequent.
ROOM = 4


class Phrases:
    """The phrases of a chunk: hashes (with the language) and first words of those of 1 to `longest` words; their texts on demand."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, langs: list[str], longest: int):
        words = Words(buf, offs, APART)
        doc = words.doc()
        codes = {x: xxhash.xxh64_intdigest(x.encode(), 12) for x in set(langs)}
        own = mix(words.hashes(lower=True) ^ np.array([codes[x] for x in langs], np.uint64)[doc])
        piece = np.cumsum(ENDS[buf])[words.starts] if len(buf) else np.zeros(0, int)
        joined = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])
        self.words, self.doc, n = words, doc, len(own)
        hashes, starts, sizes = [], [], []
        valid = np.ones(n, bool)
        for k in range(1, min(longest, n) + 1):
            if k > 1:
                valid = valid[:-1] & joined[k - 2 :]
            at = np.flatnonzero(valid)
            hashes.append(mix(gram_hashes(own, k)[at] + U64(k)))
            starts.append(at)
            sizes.append(np.full(len(at), k))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.hashes, self.starts, self.sizes = join(hashes, np.uint64), join(starts, np.int64), join(sizes, np.int64)

    def texts(self, at: np.ndarray) -> pa.Array:
        """Lower-cased words of the phrases with these numbers, joined by one space."""
        first, k = self.starts[at], self.sizes[at]
        word = np.repeat(first - np.cumsum(k) + k, k) + np.arange(int(k.sum()))
        lens = self.words.ends[word] - self.words.starts[word]
        ends = np.cumsum(lens + 1)
        out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
        inner = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
        out[inner + np.repeat(ends - lens - 1, lens)] = LOWER[self.words.buf[inner + np.repeat(self.words.starts[word], lens)]]
        stops = ends[np.cumsum(k) - 1] if len(k) else ends
        # Each text's last space is cut off by an offset one short of the next text's first byte.
        keep = np.ones(len(out), bool)
        keep[stops - 1] = False
        edges = np.concatenate([[0], stops - np.arange(1, len(stops) + 1)]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(stops), pa.py_buffer(edges), pa.py_buffer(out[keep]))


def packed(cells: np.ndarray) -> bytes:
    """Ascending cells as 16-bit differences, where 65535 means: add that and read on; cells that lie far apart as they are."""
    steps = np.diff(cells, prepend=0)
    over, rest = np.divmod(steps, 65535)
    if over.sum() > 3 * len(cells):
        return b"w" + cells.astype(np.int64).tobytes()
    out = np.full(len(cells) + int(over.sum()), 65535, np.uint16)
    out[np.arange(len(cells)) + np.cumsum(over)] = rest
    return b"d" + out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if data[:1] == b"w":
        return np.frombuffer(data, np.int64, offset=1)
    steps = np.frombuffer(data, np.uint16, offset=1)
    return np.cumsum(steps.astype(np.int64))[steps != 65535]


def folded(phrase: pa.LargeStringArray, n: np.ndarray) -> tuple[int, bytes]:
    """Ascending phrases, a line each, and their counts, byte by byte, compressed: neighbours have words in common, and few counts have more than one byte. The length before that."""
    lines = pc.binary_join_element_wise(phrase, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    ends = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
    text = lines.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes()
    data = text + n.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(data), pa.Codec("zstd", 3).compress(data, asbytes=True)


def unfolded(k: int, long: int, data: bytes) -> tuple[pa.LargeStringArray, pa.Array]:
    """The k phrases and counts again."""
    got = np.frombuffer(pa.Codec("zstd").decompress(data, long), np.uint8)
    text, counts = got[: long - 8 * k], got[long - 8 * k :]
    ends = np.concatenate([[0], np.flatnonzero(text == 10) - np.arange(k)]).astype(np.int64)
    phrase = pa.LargeStringArray.from_buffers(k, pa.py_buffer(ends), pa.py_buffer(text[text != 10]))
    return phrase, pa.array(np.ascontiguousarray(counts.reshape(8, k).T).view("<i8").ravel())


class Summary:
    """Misra-Gries counters; `taken` is what has been taken from any cell at most."""

    def __init__(self, capacity: int):
        self.capacity, self.taken, self.waiting = capacity, 0, []
        self.cells, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.size = 0

    def add(self, cells: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((cells, counts))
        self.size += len(cells)
        if self.size > self.capacity:
            self.merge()

    def merge(self) -> None:
        cells = np.concatenate([self.cells, *(c for c, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(n for _, n in self.waiting)])
        self.waiting, self.size = [], 0
        if not len(cells):
            return
        order = np.argsort(cells, kind="stable")
        cells, counts = cells[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        cells, counts = cells[first], np.add.reduceat(counts, first)
        if len(cells) > self.capacity:
            at = len(cells) - self.capacity - 1
            less = int(np.partition(counts, at)[at])
            self.taken += less
            cells, counts = cells[counts > less], counts[counts > less] - less
        self.cells, self.counts = cells, counts

    def left(self, least: int) -> np.ndarray:
        self.merge()
        return self.cells[self.counts + self.taken >= least]


def sizes_for(mass: int) -> tuple[int, int]:
    """(log2 of the number of partitions, log2 of the cells of each) for so many occurrences: over 64 cells for each."""
    parts = min(14, max(4, (mass // SHARE).bit_length()))
    return parts, min(44, max(10, (mass >> parts).bit_length() + 7))


def summaries(own: DataFrame, longest: int, parts: int, bits: int) -> DataFrame:
    """p, cells, counts, large, mass: each task's packed counts of the cells of each partition. own: lang, x."""

    def packing(codes: list[np.ndarray]):
        code = np.concatenate(codes)
        codes.clear()
        code.sort()
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        n = np.diff(first, append=len(code))
        code = code[first]
        cuts = np.append(np.searchsorted(code, np.arange(1 << parts, dtype=np.uint64) << U64(bits)), len(code))
        rows = []
        for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if b > a:
                big = np.flatnonzero(n[a:b] > 255)
                cell = (code[a:b] & U64((1 << bits) - 1)).astype(np.int64)
                rows.append((i, packed(cell), np.minimum(n[a:b], 255).astype(np.uint8).tobytes(), np.stack([big, n[a:b][big]]).astype(np.int64).tobytes(), int(n[a:b].sum())))
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
        for at in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at : at + 64]), kinds)], names=["p", "cells", "counts", "large", "mass"])

    def run(batches):
        held, size = [], 0
        for rows, buf, offs in chunks(batches, "x"):
            held.append(Phrases(buf, offs, rows.column(0).to_pylist(), longest).hashes >> U64(64 - parts - bits))
            size += len(held[-1])
            if size >= HELD_CELLS:
                yield from packing(held)
                size = 0
        if size:
            yield from packing(held)

    return own.mapInArrow(run, "p int, cells binary, counts binary, large binary, mass long")


def places(cell: np.ndarray, slice_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a cell in its partition's slice of the filter."""
    h = mix(cell.astype(np.uint64) + U64(1))
    return (h % U64(slice_bits)).astype(np.int64), ((h >> U64(32)) % U64(slice_bits)).astype(np.int64)


def possible(packs: DataFrame, least: int, slice_bits: int) -> DataFrame:
    """p, bits, kept, taken: for each partition the slice of the filter that holds all cells with `least` occurrences or more."""
    own = packs.withColumn("total", F.sum("mass").over(Window.partitionBy("p"))).select("p", "cells", "counts", "large", "total")

    def done(p: int, summary: Summary):
        cells = summary.left(least)
        bits = np.zeros(slice_bits, bool)
        for at in places(cells, slice_bits):
            bits[at] = True
        return pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()]), pa.array([len(cells)]), pa.array([summary.taken])], names=["p", "bits", "kept", "taken"])

    def run(batches):
        now, summary = None, None
        for batch in batches:
            for p, cells, counts, large, total in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if p != now:
                    if summary:
                        yield done(now, summary)
                    now, summary = p, Summary(ROOM * total // least + 1)
                n = np.frombuffer(counts, np.uint8).astype(np.int64)
                big = np.frombuffer(large, np.int64).reshape(2, -1)
                n[big[0]] = big[1]
                summary.add(unpacked(cells), n)
        if summary:
            yield done(now, summary)

    return own.mapInArrow(run, "p int, bits binary, kept long, taken long")


def counts(own: DataFrame, longest: int, least: int) -> DataFrame:
    """lang, phrase, f: all phrases with `least` occurrences or more; phrase is null for the number of all words of the language. own: lang, x."""
    spark = own.sparkSession
    size = own.agg(F.sum(F.octet_length("x"))).first()[0] or 0
    parts, bits = sizes_for(longest * size // 6)
    slice_bits = max(64, min(FILTER_BITS, 1 << (4 * longest * size // least).bit_length()) >> parts)
    found = possible(summaries(own, longest, parts, bits), least, slice_bits).select("p", "bits").collect()
    whole = np.zeros((1 << parts, slice_bits // 8), np.uint8)
    for r in found:
        whole[r["p"]] = np.frombuffer(r["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(whole)

    def passing(phrases: Phrases) -> np.ndarray:
        code = phrases.hashes >> U64(64 - parts - bits)
        p, ok = (code >> U64(bits)).astype(np.int64), np.ones(len(code), bool)
        for at in places((code & U64((1 << bits) - 1)).astype(np.int64), slice_bits):
            ok &= (shared.value[p, at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return np.flatnonzero(ok)

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []
        totals: dict[str, int] = {}
        names: dict[str, int] = {}

        def out():
            h, n, code = (np.concatenate([x[i] for x in held]) for i in range(3))
            order = np.argsort(h, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
            n, own = np.add.reduceat(n[order], first), order[first]
            phrase = pa.chunked_array([x[3] for x in held]).take(pa.array(own)).combine_chunks()
            key = (h[own] >> U64(64 - parts)).astype(np.int64) * len(names) + code[own]
            by = pc.sort_indices(phrase).to_numpy()
            by = by[np.argsort(key[by], kind="stable")]
            phrase, key, n, known = phrase.take(pa.array(by)), key[by], n[by], list(names)
            edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])).tolist()
            rows = [(int(key[a]) // len(known), known[key[a] % len(known)], b - a, *folded(phrase[a:b], n[a:b])) for a, b in zip(edges[:-1], edges[1:])]
            for i in range(0, len(rows), 256):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + 256]), kinds)], names=columns)

        for rows, buf, offs in chunks(batches, "x"):
            langs = rows.column(0).to_pylist()
            phrases = Phrases(buf, offs, langs, longest)
            for lang, n in zip(langs, phrases.words.counts.tolist()):
                totals[lang] = totals.get(lang, 0) + n
            own = passing(phrases)
            h, first, n = np.unique(phrases.hashes[own], return_index=True, return_counts=True)
            own = own[first]
            code = np.array([names.setdefault(x, len(names)) for x in langs], np.int64)[phrases.doc[phrases.starts[own]]]
            held.append((h, n, code, phrases.texts(own)))
            if sum(len(x[0]) for x in held) >= HELD_PHRASES:
                yield from out()
                held.clear()
        if sum(len(x[0]) for x in held):
            yield from out()
        m = len(totals)
        yield pa.RecordBatch.from_arrays([pa.array([-1] * m, pa.int32()), pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary())], names=columns)

    def added(batches):
        now, held, size, most = None, [], 0, HELD_PHRASES

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("phrase", use_threads=False).aggregate([("n", "sum")]).rename_columns(["phrase", "n"])

        def done():
            found = merged()
            found = found.filter(pc.or_(pc.is_null(found["phrase"]), pc.greater_equal(found["n"], least)))
            for part in found.to_batches(max_chunksize=1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array([now[1]] * part.num_rows, pa.string()), part.column(0).cast(pa.string()), part.column(1)], names=["lang", "phrase", "f"])

        for batch in batches:
            for p, lang, k, long, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (p, lang) != now:
                    if held:
                        yield from done()
                    now, held, size, most = (p, lang), [], 0, HELD_PHRASES
                phrase, n = (pa.nulls(1, pa.large_string()), pa.array([k])) if p < 0 else unfolded(k, long, data)
                held.append(pa.table({"phrase": phrase, "n": n}))
                size += len(phrase)
                if size > most:
                    held = [merged()]
                    size = len(held[0])
                    most = max(HELD_PHRASES, 2 * size)
        if held:
            yield from done()

    columns, kinds = ["p", "lang", "k", "long", "data"], (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary())
    parts_of = own.mapInArrow(run, "p int, lang string, k long, long long, data binary")
    return parts_of.repartition("p", "lang").sortWithinPartitions("p", "lang").mapInArrow(added, "lang string, phrase string, f long")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, absorbed: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` candidates, without those that occur within a longer candidate `absorbed` per cent of the time or more.

    l and r are the counts of the parts of the lowest-scoring cut (ties: the first), n the number of the language's words. Products are decimals of 38 digits.
    """
    bounded_batches(docs.sparkSession)
    own = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), docs[text].cast("string").alias("x"))
    found = cut(counts(own, longest, least))
    known = found.where("phrase is not null").withColumn("w", F.split("phrase", " "))
    many = known.where(F.size("w") > 1)
    words = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda k: F.array(F.struct((2 * k).alias("role"), words(F.lit(1), k).alias("part")), F.struct((2 * k + 1).alias("role"), words(k + 1, F.size("w") - k).alias("part"))))
    parts = many.select("lang", "phrase", F.explode(F.flatten(cuts)).alias("c")).select("lang", "phrase", "c.role", "c.part")
    parts = parts.join(known.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"]).select("lang", "phrase", "role", "f")
    # Role 0 is the phrase's own count, role 1 that of the most frequent longer candidate around it.
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: words(i, k))))
    around = many.where(F.size("w") > 2).select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.lit(1).alias("role"), "f")
    rows = parts.unionByName(around).unionByName(many.select("lang", "phrase", F.lit(0).alias("role"), "f"))
    each = rows.groupBy("lang", "phrase").agg(*(F.max(F.when(F.col("role") == i, F.col("f"))).alias(f"f{i}") for i in range(2 * longest)))
    kept = each.where((F.col("f1").isNull()) | (100 * F.col("f1") < absorbed * F.col("f0")))
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    score = lambda k: F.when(F.col(f"f{2 * k}").isNotNull(), F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * wide("f0") * wide("f0"), wide(f"f{2 * k}") * wide(f"f{2 * k + 1}")))
    options = F.filter(F.array(*(F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"f{2 * k}").alias("l"), F.col(f"f{2 * k + 1}").alias("r")) for k in range(1, longest))), lambda c: c["score"].isNotNull())
    scored = kept.select("lang", "phrase", F.col("f0").alias("a"), F.array_min(options).alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = found.where("phrase is null").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
