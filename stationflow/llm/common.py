"""Shared helpers: bounded Arrow batches, byte-level words and hashes, lineage cuts, connected components."""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are worked on at once; only a single longer document exceeds it.
CHUNK_BYTES = 1 << 20
ARROW_ROWS = 1000
U64 = np.uint64

#: White space of the word pattern [^\x20\x09-\x0D]+, by byte.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_MULT = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = _MULT) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (or more)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        up = np.full(size, base & (2**64 - 1), np.uint64)
        down = np.full(size, pow(base, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        have = _powers[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Words:
    """Words of the texts of one chunk: byte starts and ends, and each document's first word (one more at the end)."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE):
        word = ~space[buf]
        cuts = offs[(offs > 0) & (offs < len(buf))]
        before = np.zeros(len(buf), bool)
        before[1:] = word[:-1]
        before[cuts] = False
        after = np.zeros(len(buf), bool)
        after[:-1] = word[1:]
        after[cuts - 1] = False
        self.buf = buf
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, offs)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        buf = LOWER[self.buf] if lower else self.buf
        up, down = powers(len(buf) + 1)
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * up[: len(buf)], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """A hash for each run of k consecutive word hashes; runs over document ends are the caller's to mask."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    up, down = powers(len(words) + 1, base)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[: len(words) - k + 1])


def chunks(batches, column: str = "text", limit: int = CHUNK_BYTES):
    """(rows, bytes, offsets) for slices of the batches with at most `limit` bytes of text, or one row. Null text counts as empty."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        texts = texts.cast(pa.large_binary()) if texts.type != pa.large_binary() else texts
        if texts.null_count:
            texts = texts.fill_null(b"")
        n = len(texts)
        if not n:
            continue
        offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        data = texts.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at), data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
            at = to


def whole_groups(rows: DataFrame, work, schema: str, held_bytes: int = 1 << 26) -> DataFrame:
    """work(table) of tables that hold whole groups of the column g, sorted by g, of about held_bytes or one larger group; it gives record batches."""
    names = rows.columns

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.nbytes for b in held) < held_bytes:
                continue
            table = pa.Table.from_batches(held)
            g = table.column("g").to_numpy()
            last = int(np.argmax(g == g[-1]))
            if last:
                yield from work(table.slice(0, last).select(names))
            held = table.slice(last).combine_chunks().to_batches()
        if held:
            yield from work(pa.Table.from_batches(held).select(names))

    bounded_batches(rows.sparkSession)
    return rows.repartition("g").sortWithinPartitions("g").mapInArrow(run, schema)


def bounded_batches(spark: SparkSession) -> None:
    """Python workers get few rows at a time, so their memory doesn't grow with text length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset: one of its own in local mode, as in tests; on a cluster, an error."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage by a checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node of an edge: root is the smallest node of its connected component.

    Alternating large-star and small-star steps: each halves the trees' heights at least, every step is a
    partially aggregated minimum and an equi-join, and the edges never leave the executors.
    edges: columns a, b of one orderable type. Empty edges give no rows.
    """
    pair = lambda df, x, y: df.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).where("a <> b").distinct()
    now = cut(pair(edges, F.col("a"), F.col("b")))
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).withColumn("m", F.least("n", "m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("x"), F.col("m").alias("y"))
        own = least.where("m < n").select(F.col("n").alias("x"), F.col("m").alias("y"))
        large = pair(large.union(own), F.col("x"), F.col("y"))
        best = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(best, F.col("a") == F.col("n")).select(F.col("b").alias("x"), F.col("m").alias("y"))
        after = cut(pair(small.union(best.select("n", "m")), F.col("x"), F.col("y")))
        same = now.count() == after.count() and after.join(now, ["a", "b"], "left_anti").isEmpty()
        now = after
        if same:
            break
    stars = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
