"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded buckets, star-shaped candidate edges.

A text's set holds its distinct word shingles (words lower-cased, A-Z), as 64-bit hashes; with fewer words than a shingle, the whole sequence
is the one element. Two texts are linked if the exact Jaccard similarity of their sets is `similarity` or more; groups are the connected
components of the links.

Signature: one hash a shingle. Its upper bits choose one of BINS bins, and a bin keeps its least hash. An empty bin takes the value of the bin
that a fixed pseudo-random walk of its own meets first, so that any bin of two sets agrees with a probability of their similarity.
Candidates: BAND bins make a bucket key. Of texts at similarity 0.8 a share of (1 - 0.8^4)^32, 5e-8, shares no bucket. A bucket gives star-shaped
edges, not all pairs: its first member is a centre for every other whose signature agrees; those that don't agree with it get centres of
their own in turn. So the edges are fewer than the bucket's members, and no two members with agreeing signatures stay unconnected.
Links: shingle sets are made for texts with a candidate edge only, are brought together once for each component of those edges, and are compared in full,
again in stars: a pair that is connected already isn't compared. Equal sets are one node from the start, so copies cost one row each.

Hot keys: buckets over `tile` nodes, and components over it or over SHINGLES shingles, are dealt out as pairs of tiles. Buckets with the same
members are compared once. Shuffled are keys, signatures and the sets of candidates; texts once, by key, for those sets.

Defined results: texts that are null or have no word have an empty set, are linked with nothing and are a group of their own (component_id is their
own id). Rows with a null id take part and get the group's least id; kept is false for them. Repeated rows each give a row. An
empty table gives no rows. Other columns are ignored, whatever their names. Sets are told apart by a 64-bit key and their size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, Words, bounded_batches, chunks, components, cut, gram_hashes, mix, whole_groups
from .simhash import SHINGLES, tiled

BINS, BAND = 128, 4
BANDS = BINS // BAND
NONE = U64(0xFFFFFFFFFFFFFFFF)
#: Attempts of an empty bin's walk; after these it takes the next filled bin.
WALK = 256
_STEPS = np.random.Generator(np.random.PCG64(5)).integers(0, BINS, (WALK, BINS))


def shingle_sets(buf: np.ndarray, offs: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text of a chunk in ascending order, and each text's first."""
    words = Words(buf, offs)
    hashes = words.hashes(lower=True)
    n = words.counts
    parts = [gram_hashes(hashes, k) for k in range(1, shingle + 1)]
    per = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    width = np.minimum(n, shingle)
    doc = np.repeat(np.arange(len(n)), per)
    lead = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per - words.first[:-1], per)
    out = np.zeros(len(doc), np.uint64)
    for k in range(1, shingle + 1):
        own = width[doc] == k
        out[own] = mix(parts[k - 1][lead[own]] + U64(k))
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=len(n)))]).astype(np.int64)


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The least hash of each bin after densification, sets by bins. Empty sets have no signature (all NONE)."""
    n = len(first) - 1
    at = np.repeat(np.arange(n) * BINS, np.diff(first)) + (hashes >> U64(64 - BINS.bit_length() + 1)).astype(np.int64)
    least = np.full(n * BINS, NONE)
    np.minimum.at(least, at, hashes)
    least = least.reshape(n, BINS)
    out, filled = least.copy(), least != NONE
    row, bin = np.nonzero(~filled & (np.diff(first) > 0)[:, None])
    for steps in _STEPS:
        if not len(row):
            return out
        to = steps[bin]
        hit = filled[row, to]
        out[row[hit], bin[hit]] = least[row[hit], to[hit]]
        row, bin = row[~hit], bin[~hit]
    if len(row):
        around = (bin[:, None] + np.arange(BINS)) % BINS
        to = around[np.arange(len(row)), filled[row[:, None], around].argmax(axis=1)]
        out[row, bin] = least[row, to]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A bucket key for each band, sets by bands."""
    own = signature.reshape(len(signature), BANDS, BAND)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), own.shape[:2]).copy()
    for i in range(BAND):
        keys = mix(keys + own[:, :, i])
    return keys


def stars(sketch: np.ndarray, size: np.ndarray, agree: float, percent: int, sets: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges (centre, member) that connect all pairs of one group whose sizes and sketches allow the similarity and, with sets, whose sets have it."""
    n = len(sketch)
    label = np.arange(n)
    centres, members = [], []
    if sets is not None:
        flat, starts = np.concatenate(sets), np.concatenate([[0], np.cumsum(size)])
    for i in range(n - 1):
        rest = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
        if not len(rest):
            break
        rest = rest[100 * np.minimum(size[rest], size[i]) >= percent * np.maximum(size[rest], size[i])]
        rest = rest[(sketch[rest] == sketch[i]).mean(axis=1) >= agree]
        if sets is not None and len(rest):
            lens = size[rest]
            ends = np.cumsum(lens)
            theirs = flat[np.arange(ends[-1]) + np.repeat(starts[rest] - ends + lens, lens)]
            own = sets[i]
            found = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
            shared = np.add.reduceat(found.astype(np.int64), ends - lens)
            rest = rest[100 * shared >= percent * (lens + size[i] - shared)]
        if len(rest):
            labels, one = np.unique(label[rest], return_index=True)
            centres.append(np.full(len(one), i))
            members.append(rest[one])
            label[np.isin(label, labels)] = label[i]
    return (np.concatenate(centres), np.concatenate(members)) if centres else (np.zeros(0, int), np.zeros(0, int))


def compared(rows: DataFrame, agree: float, percent: int) -> DataFrame:
    """Edges a, b of the stars in every group. rows: g, node, size, sketch and, for links and not candidates, set."""

    def work(table: pa.Table):
        g, node, size = (table.column(c).to_numpy() for c in ("g", "node", "size"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()] if "set" in table.column_names else None
        starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1], [True]]))
        a, b = [], []
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if e - s > 1:
                x, y = stars(sketch[s:e], size[s:e], agree, percent, sets and sets[s:e])
                a.append(node[s + x])
                b.append(node[s + y])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return whole_groups(rows, work, "a long, b long").distinct()


def prints_of(own: DataFrame, shingle: int) -> DataFrame:
    """id, __k, __t, size of every row; node, keys and sketch of rows whose set isn't empty. own: these columns and __x, the text."""

    def run(batches):
        for rows, buf, offs in chunks(batches, "__x"):
            hashes, first = shingle_sets(buf, offs, shingle)
            size = np.diff(first)
            signature = signatures(hashes, first)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ U64(0x5851F42D4C957F2D)))])
            node = mix(sums[first[1:]] - sums[first[:-1]] + size.astype(np.uint64)).view(np.int64)
            keys = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * BANDS), pa.array(band_keys(signature).view(np.int64).ravel()))
            sketch = pa.array([r.tobytes() for r in mix(signature).astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(size), pa.array(node), keys, sketch], names=["id", "__k", "__t", "size", "node", "keys", "sketch"])

    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, __k long, __t long, size long, node long, keys array<long>, sketch binary")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, similarity: float = 0.8, tile: int = 4096) -> DataFrame:
    """id, n_shingles, component_id (the least id of the group) and kept (is it this row's id?) for every row."""
    bounded_batches(docs.sparkSession)
    percent = round(100 * similarity)
    agree = similarity - 5 * (similarity * (1 - similarity) / BINS) ** 0.5
    own = docs.select(docs[id].alias("id"), docs[text].cast("string").alias("__x")).withColumns({"__k": F.xxhash64(F.lit(1), "id"), "__t": F.xxhash64("__x")}).select("id", "__k", "__t", "__x")
    prints = cut(prints_of(own, shingle))
    order = F.struct(F.col("id").isNull().alias("n"), "id", "__t", "__k")
    nodes = cut(prints.where("size > 0").groupBy("node", "size", "keys", "sketch").agg(F.min(order).alias("o")))

    keyed = nodes.select("node", F.explode("keys").alias("key"))
    full = keyed.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("members")).where("n > 1")
    full = full.groupBy("n", "members").agg(F.min("key").alias("key")).select("key")
    buckets = tiled(keyed.join(full, "key"), "node", ["key"], tile).select("node", "g")
    near = components(compared(buckets.join(nodes.select("node", "size", "sketch"), "node"), agree, percent))

    members = cut(nodes.join(near, "node").select("node", "root", "size", "sketch", "keys", "o.__k", "o.__t"))
    tiles = members.groupBy("root").agg(F.greatest(F.count("*") / tile, F.sum("size") / SHINGLES).alias("tiles"))
    placed = members.join(tiles, "root").select("node", "root", "size", "keys", "tiles")
    groups = tiled(placed.where(F.col("tiles") <= BANDS).select("node", "root", "size"), "node", ["root"], tile, "size").select("node", "g")
    large = placed.where(F.col("tiles") > BANDS).select("node", "root", "size", F.explode("keys").alias("key"))
    groups = groups.unionByName(tiled(large, "node", ["root", "key"], tile, "size").select("node", "g"))

    def sets(batches):
        for rows, buf, offs in chunks(batches, "__x"):
            hashes, first = shingle_sets(buf, offs, shingle)
            own = pa.array([hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns[:3], own], names=["node", "size", "sketch", "set"])

    one = F.row_number().over(Window.partitionBy("__k", "__t").orderBy(F.lit(1)))
    texts = own.select("__k", "__t", "__x").join(members.select("node", "size", "sketch", "__k", "__t"), ["__k", "__t"]).withColumn("__r", one).where("__r = 1").select("node", "size", "sketch", "__x")
    found = components(compared(groups.join(texts.mapInArrow(sets, "node long, size long, sketch binary, set binary"), "node"), agree, percent))
    rooted = nodes.select("node", F.col("o.id").alias("least")).join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = rooted.join(least, "root").select("node", "component_id")
    got = prints.select("id", "size", F.when(F.col("size") > 0, F.col("node")).alias("node")).join(groups, "node", "left")
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id"))
    return got.select(F.col("id").alias(id), F.col("size").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
