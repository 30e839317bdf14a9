"""Sequence packing as a cutting-stock problem, solved by column generation.

A document's token ids, with an end id, are cut into full sequences of `size` tokens and one remainder. Each piece's
length, rounded up to `grain` tokens, is its class. The exact histogram of classes (at most size / grain numbers, so
its size doesn't depend on the corpus) goes to the driver, where a linear program over patterns (multisets of classes that fit in
a sequence) is solved by column generation: revised simplex, and an unbounded-knapsack dynamic program that prices new
patterns, until the bound on the optimum is within `gap`. Pattern counts are rounded down; what remains is packed
greedily. Then every piece gets its rank within its class on Spark, and the rank alone says which sequence it goes to.

Ranks come from per-shard row numbers and a running sum of shard counts, so no class is gathered in one task.

Defined results: null and empty texts are one piece that holds the end id. Repeated rows are packed once each. Pieces of
equal class are ranked by hash shard, then id, start, checksum: ties are equal rows, and which is which doesn't matter. An empty
table gives no rows. A text that holds a special token's string gets that token's id there, as the library gives it as loaded. Other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, cut

#: Fixed value: the public pattern that splits text before byte-level merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_UNITS = 400_000


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1 stands for itself, the rest for 256 and up."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE vocabulary file, as little-endian 32-bit bytes.

    The split pattern never joins what stands before and after a space, except in runs of white space with two spaces in a row;
    so a text is encoded by its space-separated units, each looked up in a bounded cache. Texts with two spaces in a row are encoded whole.
    Texts with the string of an added token (special ones among them) go through the library that owns the file format, as loaded.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, self.added = file["model"], tuple(t["content"] for t in file["added_tokens"])
        self.library = Tokenizer.from_file(path)
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if all(c in alphabet for c in token) and token not in self.added}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(merged):
            raise ValueError("the ids of the merges are not in merge order")
        self.ranks = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.ranks.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            ids = self.library.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        if "  " in text or not text:
            return self.whole(text)
        head, *units = text.split(" ")
        parts = list(map(self.cache.get, units))
        if None in parts:
            if len(self.cache) > CACHE_UNITS:
                self.cache.clear()
            for i, part in enumerate(parts):
                if part is None:
                    parts[i] = self.cache[units[i]] = self.whole(" " + units[i])
        return self.whole(head) + b"".join(parts)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, path: str, size: int = 2048, end: int = 1, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece: full sequences from the start, then the remainder."""
    bounded_batches(docs.sparkSession)
    own = docs.select(docs[id].alias("doc_id"), docs[text].cast("string").alias("text"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    tail = struct.pack("<I", end)

    def run(batches):
        encode = encoder(path)
        for batch in batches:
            of, out = [], []
            for i, t in enumerate(batch.column(1)):
                ids = encode(t.as_py() or "") + tail
                n = len(ids) // 4
                for start in range(0, n, size):
                    part = ids[4 * start : 4 * (start + size)]
                    of.append(i)
                    out.append((start, len(part) // 4, zlib.crc32(part), n))
            rows = np.array(out, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *map(pa.array, rows.T.copy())], names=names)

    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long")


def price(duals: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of greatest value. duals[i] is the value of an item of i + 1 units."""
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        values = best[c - 1 :: -1][:c] + duals[:c]
        i = int(values.argmax())
        best[c], took[c] = (values[i], i + 1) if values[i] > best[c - 1] else (best[c - 1], 0)
    pattern, c = np.zeros(len(duals), np.int64), capacity
    while c:
        pattern[took[c] - 1] += took[c] > 0
        c -= max(1, took[c])
    return float(best[capacity]), pattern


def inverted(matrix: np.ndarray) -> np.ndarray | None:
    """The inverse, by row operations with pivots; None if it is singular to working precision.

    LAPACK's own threads can wait for ever on the driver once it has started the JVM, and a basis has few hundred rows at most.
    """
    n = len(matrix)
    work = np.concatenate([matrix.astype(float), np.eye(n)], axis=1)
    for i in range(n):
        p = i + int(np.abs(work[i:, i]).argmax())
        if abs(work[p, i]) < 1e-10:
            return None
        work[[i, p]] = work[[p, i]]
        work[i] /= work[i, i]
        rest = work[:, i].copy()
        rest[i] = 0
        work -= rest[:, None] * work[i]
    return work[:, n:]


def solve(demand: np.ndarray, gap: float = 0.005, smooth: float = 0.8) -> list[tuple[np.ndarray, float]]:
    """Column generation for min sum(x) with sum(x_p * pattern_p) = demand: patterns of the basis and their counts.

    demand[i]: pieces of i + 1 units; a sequence has len(demand) units. Stops when no pattern prices out, or when the best
    lower bound (the duals' value over the greatest pattern value) is within gap of the objective, or when steps no longer lower it.
    """
    capacity = len(demand)
    rows = np.flatnonzero(demand)
    if not len(rows):
        return []
    d = demand[rows].astype(float)
    basis = np.diag(capacity // (rows + 1)).astype(np.int64)
    inverse = np.diag(1.0 / np.diag(basis))
    x = (inverse * d).sum(axis=1)  # not BLAS: its threads cost more than they save at this size
    steps, centre, bound = 0, d * 0, 0.0
    best, stalled = np.inf, 0
    while stalled <= 2 * len(rows) + 16:  # degenerate steps may cycle; any basis gives a plan for all pieces
        y = inverse.sum(axis=0)
        if x.sum() <= bound * (1 + gap):
            break
        stalled = 0 if x.sum() < best * (1 - 1e-9) else stalled + 1
        best = min(best, float(x.sum()))
        # Prices between those of the best bound so far and the basis's keep the duals from swinging.
        for weight in (smooth, 0.0):
            at = weight * centre + (1 - weight) * y
            duals = np.zeros(capacity)
            duals[rows] = np.maximum(at, 0)
            value, pattern = price(duals, capacity)
            if value > 0 and (low := float((d * duals[rows]).sum()) / max(value, 1)) > bound:
                bound, centre = low, duals[rows] / max(value, 1)
            if (y * pattern[rows]).sum() > 1 + 1e-7:
                break
        else:
            break
        column = (inverse * pattern[rows]).sum(axis=1)
        ratio = np.where(column > 1e-9, x / np.where(column > 1e-9, column, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        x -= step * column
        x[out] = step
        np.maximum(x, 0, out=x)
        pivot = inverse[out] / column[out]
        inverse -= np.outer(column, pivot)
        inverse[out] = pivot
        basis[:, out] = pattern[rows]
        steps += 1
        if steps % 200 == 0 and (exact := inverted(basis)) is not None:
            inverse, x = exact, np.maximum((exact * d).sum(axis=1), 0)
    full = np.zeros((len(rows), capacity), np.int64)
    full[:, rows] = basis.T
    return list(zip(full, x))


def rounded(demand: np.ndarray, solution: list[tuple[np.ndarray, float]]) -> list[tuple[np.ndarray, int]]:
    """Whole pattern counts that meet the demand exactly: rounded down, and greedy largest-first patterns for the rest."""
    rest, out = demand.astype(np.int64).copy(), []
    for pattern, x in solution:
        used = pattern > 0
        n = min(int(x + 1e-6), int((rest[used] // pattern[used]).min())) if used.any() else 0
        if n > 0:
            out.append((pattern, n))
            rest -= n * pattern
    while rest.any():
        pattern, room = np.zeros_like(rest), len(rest)
        for i in np.flatnonzero(rest)[::-1]:
            take = min(int(rest[i]), room // (i + 1))
            pattern[i] = take
            room -= take * (i + 1)
        used = pattern > 0
        n = int((rest[used] // pattern[used]).min())
        out.append((pattern, n))
        rest -= n * pattern
    return out


class Plan:
    """Where each rank of each class goes. Arrays are sorted by class and first rank."""

    def __init__(self, patterns: list[tuple[np.ndarray, int]], classes: int):
        given, base, rows = np.zeros(classes, np.int64), 0, []
        for pattern, n in patterns:
            for i in np.flatnonzero(pattern):
                rows.append(((int(i) << 44) + int(given[i]), int(pattern[i]), base))
                given[i] += n * int(pattern[i])
            base += n
        rows.sort()
        self.key, self.each, self.base = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3

    def place(self, cls: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and slot within it, of the pieces of a class (from 0) and rank (from 0)."""
        key = (cls << 44) + rank
        at = np.searchsorted(self.key, key, "right") - 1
        past = key - self.key[at]
        return self.base[at] + past // self.each[at], past % self.each[at]


def pack(own: DataFrame, size: int = 2048, grain: int = 8, gap: float = 0.005, shards: int = 64, shard_rows: int = 100_000) -> DataFrame:
    """The columns of pieces() and sequence_id, offset. own: what pieces() gives, materialised."""
    classes = -(-size // grain)
    own = own.withColumn("cls", (F.ceil(F.col("length") / grain) - 1).cast("long"))
    histogram = own.groupBy("cls").agg(F.count("*").alias("n")).collect()  # at most `classes` rows
    demand = np.zeros(classes, np.int64)
    for row in histogram:
        demand[row["cls"]] = row["n"]
    plan = Plan(rounded(demand, solve(demand, gap)), classes)
    shards = max(shards, -(-int(demand.sum()) // shard_rows))
    own = own.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shards)))
    counts = own.groupBy("cls", "shard").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("cls").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("cls", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    within = Window.partitionBy("cls", "shard").orderBy("doc_id", "start", "ids_crc32", "length", "doc_tokens")
    ranked = own.withColumn("rank", F.row_number().over(within) - 1).join(counts, ["cls", "shard"]).withColumn("rank", F.col("rank") + F.col("before"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    ranked = ranked.select(*names, "cls", "rank")

    def run(batches):
        for b in batches:
            seq, slot = plan.place(b.column("cls").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(slot), b.column("cls")], names=[*names, "sequence_id", "slot", "cls"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields[:5])
    placed = ranked.mapInArrow(run, f"{kinds}, sequence_id long, slot long, cls long")
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("cls"), "slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*names, "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset"))


def pack_documents(docs: DataFrame, path: str, size: int = 2048, end: int = 1, id: str = "doc_id", text: str = "text", grain: int = 8, gap: float = 0.005) -> DataFrame:
    return pack(cut(pieces(docs, path, size, end, id, text)), size, grain, gap)
