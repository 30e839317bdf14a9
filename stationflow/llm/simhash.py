"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints: each text's word shingles are hashed with XXH64 (seed 42); a bit of the 64-bit fingerprint is 1 if
it is set in over half of the hashes, repeats included. Links: distinct fingerprints that differ in `radius` bits
or fewer. Groups: connected components of the links.

Search: the 64 bits are cut into `blocks` blocks. Two fingerprints within the radius agree on at least
blocks - radius of them, so every choice of that many blocks is a bucket key and no link is lost. Only buckets with
two or more distinct fingerprints are compared. Within a bucket the fingerprints are stored as vertical bit planes:
one machine word holds the same bit of 64 fingerprints, a carry-save counter adds up the differing bits of 64 pairs at
once, and the comparison of a block of pairs is abandoned as soon as all its counters exceed the radius. A task gives
a spanning star for what it has linked, not all pairs. Buckets over `tile` fingerprints are dealt out as pairs of tiles.

Defined results: null and empty texts have no word, so fingerprint zero, and are linked like any other; texts with
fewer words than a shingle have one shingle of all their words; copies share a fingerprint and never meet in a bucket,
so a group of copies costs one row. Rows with a null id are grouped too, but give no component id. Repeated rows each
give a row. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, Words, bounded_batches, chunks, components, cut, mix

U64 = np.uint64
#: Words or shingles that are worked on at once: what a long text needs beside its characters and hashes does not grow with it.
SLICE = 1 << 18


def slices(n: int) -> list[slice]:
    return [slice(at, min(n, at + SLICE)) for at in range(0, n, SLICE)]


def joined(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words of a chunk, lower-cased (A-Z) and joined by one space, with each word's start and end."""
    lens = words.ends - words.starts
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 32, np.uint8)
    for s in slices(len(lens)):
        own = lens[s]
        at = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        out[at + np.repeat(starts[s], own)] = LOWER[words.buf[at + np.repeat(words.starts[s], own)]]
    return out.tobytes(), starts, ends


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each document's fingerprint; document i has hashes[first[i]:first[i + 1]]."""
    sizes = np.diff(first)
    ones = np.zeros((len(sizes), 64), np.int64)
    for s in slices(len(hashes)):
        edges = np.clip(first, s.start, s.stop) - s.start
        full = np.flatnonzero(np.diff(edges))
        bits = np.unpackbits(hashes[s].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[full] += np.add.reduceat(bits, edges[full], axis=0, dtype=np.int32)
    packed = np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64).reshape(-1)


def shingle_hashes(buf: np.ndarray, offs: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all shingles of a chunk, and each document's first."""
    words = Words(buf, offs)
    text, starts, ends = joined(words)
    n = words.counts
    per = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(per)])
    lead = np.arange(first[-1]) - np.repeat(first[:-1] - words.first[:-1], per)
    last = np.minimum(lead + shingle, np.repeat(words.first[1:], per)) - 1
    out = np.zeros(int(first[-1]), np.uint64)
    for s in slices(len(out)):
        spans = map(slice, starts[lead[s]].tolist(), ends[last[s]].tolist())
        out[s] = np.fromiter(map(xxhash.xxh64_intdigest, map(text.__getitem__, spans), repeat(42)), np.uint64, s.stop - s.start)
    return out, first


def text_fingerprints(buf: np.ndarray, offs: np.ndarray, shingle: int) -> np.ndarray:
    return majority(*shingle_hashes(buf, offs, shingle))


SKETCH, KEYS = 64, 8
#: Shingles that a group of sets holds at most, or nearly, and bytes after which a task compares the whole groups it holds.
SHINGLES, HELD_BYTES = 1 << 22, 1 << 26
_rng = np.random.Generator(np.random.PCG64(11))
_XOR, _ODD = _rng.integers(0, 1 << 63, SKETCH, dtype=np.uint64), _rng.integers(0, 1 << 62, SKETCH, dtype=np.uint64) * U64(2) + U64(1)


def sketches(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The least shingle under each of SKETCH random orders, documents by orders; 0 where there is no shingle."""
    full = np.flatnonzero(np.diff(first))
    out = np.zeros((len(first) - 1, SKETCH), np.uint64)
    if len(full):
        for i in range(SKETCH):
            out[full, i] = np.minimum.reduceat((hashes ^ _XOR[i]) * _ODD[i], first[:-1][full])
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` and fp (the fingerprint as a signed long) for every row."""
    bounded_batches(docs.sparkSession)
    own = docs.select(*(docs[c] for c in keep), docs[text].cast("string").alias("__text"))

    def run(batches):
        for rows, buf, offs in chunks(batches, "__text"):
            fp = pa.array(text_fingerprints(buf, offs, shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], fp], names=[*keep, "fp"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])
    return own.mapInArrow(run, f"{kinds}, fp long")


def block_masks(blocks: int, radius: int) -> list[int]:
    """A mask for each choice of blocks - radius blocks of the 64 bits."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    own = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(own, blocks - radius)]


def planes_of(fps: np.ndarray) -> np.ndarray:
    """64 bit planes; bit i of plane p, as packed words, is bit p of fingerprint i. One spare word each."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    out = np.zeros((64, (len(fps) + 63) // 64 + 1), np.uint64)
    packed = np.packbits(bits, axis=1, bitorder="little")
    out.view(np.uint8)[:, : packed.shape[1]] = packed
    return out


def shifted(words: np.ndarray, by: int) -> np.ndarray:
    """The packed bits from position `by` on."""
    skip, rest = divmod(by, 64)
    out = words[..., skip:]
    if rest:
        high = np.zeros_like(out)
        high[..., :-1] = out[..., 1:] << U64(64 - rest)
        out = (out >> U64(rest)) | high
    return out


def close(planes: np.ndarray, by: int, valid: np.ndarray, radius: int) -> np.ndarray:
    """Packed: does fingerprint i differ from fingerprint i + by in `radius` bits at most? Only where valid."""
    ahead = shifted(planes, by)
    width = ahead.shape[1]
    alive = valid[:width].copy()
    counter = [np.zeros(width, np.uint64) for _ in range(int(radius).bit_length())]
    over = np.zeros(width, np.uint64)
    for p in range(0, 64, 2):
        x, y = planes[p, :width] ^ ahead[p], planes[p + 1, :width] ^ ahead[p + 1]
        u = x ^ y
        carry = (x & y) | (counter[0] & u) if counter else x | y
        if counter:
            counter[0] ^= u
        for c in counter[1:]:
            c_and = c & carry
            c ^= carry
            carry = c_and
        over |= carry
        if p % 8 == 6:
            above = over.copy()
            same = ~over
            for i in reversed(range(len(counter))):
                bit = counter[i]
                if radius >> i & 1:
                    same &= bit
                else:
                    above |= same & bit
                    same &= ~bit
            alive &= ~above
            if not alive.any():
                break
    return alive


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Is the Jaccard similarity of two sets, sorted arrays, at least `similarity`? Two empty sets are alike."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    both = np.sort(np.concatenate([a, b]))
    shared = int((both[1:] == both[:-1]).sum())
    return shared >= similarity * (len(both) - shared) - 1e-9


def stars(fps: np.ndarray, group: np.ndarray, radius: int, sketch: np.ndarray | None = None, agree: float = 0, sets: list[np.ndarray] | None = None, similarity: float = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rows come sorted by group. The rows that are linked within their group, and their local roots.

    With sketches, a pair within the radius is linked only if a share of `agree` of the sketches' bytes is equal;
    with sets, only if these are similar by `similarity` too (not computed for pairs that are linked already).
    """
    n = len(fps)
    root = np.arange(n)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.concatenate([starts, [n]]))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    def compare(rows: np.ndarray) -> None:
        planes, own, gid = planes_of(fps[rows]), fps[rows], group[rows]
        by = 1
        while True:
            same = gid[by:] == gid[:-by] if by < len(rows) else np.zeros(0, bool)
            if not same.any():
                return
            valid = np.zeros(planes.shape[1], np.uint64)
            packed = np.packbits(same, bitorder="little")
            valid.view(np.uint8)[: len(packed)] = packed
            found = close(planes, by, valid, radius)
            if found.any():
                hit = np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little")[: len(same)])
                a, b = rows[hit], rows[hit + by]
                if sketch is not None:
                    near = (sketch[a] == sketch[b]).mean(axis=1) >= agree
                    a, b = a[near], b[near]
                for x, y in zip(a.tolist(), b.tolist()):
                    i, j = find(x), find(y)
                    if i != j and (sets is None or alike(sets[x], sets[y], similarity)):
                        root[max(i, j)] = min(i, j)
            by += 1

    small = np.repeat(sizes, sizes) <= 64
    for part in np.array_split(np.flatnonzero(small), max(1, n // 65536)):
        compare(part) if len(part) > 1 else None
    for s, k in zip(starts[sizes > 64], sizes[sizes > 64]):
        compare(np.arange(s, s + k))
    roots = np.fromiter(map(find, range(n)), np.int64, n)
    moved = np.flatnonzero(roots != np.arange(n))
    return moved, roots[moved]


def tiled(keyed: DataFrame, own: str, by: list[str], tile: int, size: str | None = None) -> DataFrame:
    """keyed with g, the group to be compared within: buckets of one row are dropped, those of over `tile` rows (or SHINGLES in `size`) become pairs of tiles."""
    share = F.greatest(F.count("*") / tile, F.sum(size) / SHINGLES) if size else F.count("*") / tile
    full = keyed.groupBy(*by).agg(F.count("*").alias("__n"), F.ceil(share).cast("int").alias("__t")).where("__n > 1")
    rows = (
        keyed.join(full, by).withColumn("__s", F.pmod(F.xxhash64(own), F.col("__t")).cast("int"))
        .withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__t") - 1)))
        .withColumn("g", F.xxhash64(*by, F.least("__s", "__o"), F.greatest("__s", "__o"), F.lit(1)))
    )
    return rows.drop("__n", "__t", "__s", "__o")


def compared(rows: DataFrame, radius: int, agree: float | None = None, similarity: float | None = None) -> DataFrame:
    """Edges a, b of a spanning forest of the links in every group. rows: node, fp, g, with `agree` also sketch, with `similarity` also set."""
    own = rows.select("node", "fp", "g", *(["sketch"] if agree is not None else []), *(["set"] if similarity is not None else [])).repartition("g").sortWithinPartitions("g")

    def run(batches):
        held: list[pa.RecordBatch] = []

        def done(part: pa.Table):
            node, fp, g = (part.column(c).to_numpy() for c in ("node", "fp", "g"))
            sketch = None if agree is None else np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
            sets = None if similarity is None else [np.frombuffer(x, np.uint64) for x in part.column("set").to_pylist()]
            a, b = stars(fp.view(np.uint64), g, radius, sketch, agree or 0, sets, similarity or 0)
            return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if len(held) < 64 and sum(b.nbytes for b in held) < HELD_BYTES:
                continue
            table = pa.Table.from_batches(held)
            g = table.column("g").to_numpy()
            last = int(np.argmax(g == g[-1]))
            if last:
                yield done(table.slice(0, last))
            held = table.slice(last).combine_chunks().to_batches()
        if held:
            yield done(pa.Table.from_batches(held))

    bounded_batches(rows.sparkSession)
    return own.mapInArrow(run, "a long, b long").distinct()


def links(fps: DataFrame, radius: int = 3, blocks: int = 6, tile: int = 4096) -> DataFrame:
    """Edges a, b whose connected components are those of all pairs of distinct fingerprints within the radius. fps: fp, distinct."""
    masks = block_masks(blocks, radius)
    keyed = fps.select("fp", F.explode(F.array(*(F.struct(F.lit(i).cast("int").alias("c"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("long")).alias("key")) for i, m in enumerate(masks)))).alias("k")).select("fp", F.col("fp").alias("node"), "k.c", "k.key")
    return compared(tiled(keyed, "fp", ["c", "key"], tile), radius)


def labels(prints: DataFrame, radius: int = 3, blocks: int = 6, tile: int = 4096) -> DataFrame:
    """fp, root: the group of every distinct fingerprint; root is one fingerprint of the group."""
    fps = prints.select("fp").distinct()
    found = components(links(fps, radius, blocks, tile))
    return fps.join(found, fps["fp"] == found["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, blocks: int = 6, tile: int = 4096) -> DataFrame:
    """id, fp and component_id (the least id of the group) for every row."""
    prints = cut(fingerprints(docs, shingle, text, (id,)))
    own = prints.groupBy("fp").agg(F.min(id).alias("least"))
    by_fp = cut(own.join(labels(prints, radius, blocks, tile), "fp"))
    least = by_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(by_fp.join(least, "root").select("fp", "component_id"), "fp", "left").select(id, "fp", "component_id")


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8, radius: int = 24, tile: int = 4096) -> DataFrame:
    """The rows of docs without all but one of each group of near copies; the least id (then text hash) stays, one of repeated rows.

    Texts whose shingle sets are similar by `similarity` or more differ in more bits than block keys can find. So candidates are
    those that share one of KEYS least shingles (similar texts miss each other with probability (1 - similarity)^KEYS); they are compared
    by their fingerprints, bit-sliced as above, and by sketches (a byte of each least shingle). Both only sort out, wide enough (five
    standard errors) to lose nothing that could be measured at the similarity: a pair is linked if
    the exact Jaccard similarity of its shingle hash sets says so. The sets are made for texts with a candidate only, and compared within
    the connected components of the candidate pairs; components over a tile are compared by key again. Keys, fingerprints, sketches
    and these sets are shuffled; texts by key, for the sets and at the end.
    """
    bounded_batches(docs.sparkSession)
    columns, names = docs.columns, [f"own_{i}" for i in range(len(docs.columns))]
    id, text, docs = names[columns.index(id)], names[columns.index(text)], docs.toDF(*names)
    keyed = docs.withColumns({"__k": F.xxhash64(F.lit(1), id), "__t": F.xxhash64(text)})
    own = keyed.select(F.col(id).alias("id"), "__k", "__t", F.col(text).cast("string").alias("__x"))

    def run(batches):
        for rows, buf, offs in chunks(batches, "__x"):
            hashes, first = shingle_hashes(buf, offs, shingle)
            least = sketches(hashes, first)
            ends = pa.array(np.arange(len(least) + 1, dtype=np.int32) * KEYS)
            keys = pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(least[:, :KEYS] + np.arange(KEYS, dtype=np.uint64)).view(np.int64).ravel()))
            sketch = pa.array([r.tobytes() for r in mix(least).astype(np.uint8)], pa.binary())
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes))])
            whole = pa.array((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(majority(hashes, first).view(np.int64)), sketch, keys, whole, pa.array(np.diff(first))], names=["id", "__k", "__t", "fp", "sketch", "keys", "whole", "size"])

    def shingle_sets(batches):
        for rows, buf, offs in chunks(batches, "__x"):
            hashes, first = shingle_hashes(buf, offs, shingle)
            sets = pa.array([np.unique(hashes[a:b]).tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns[:3], sets], names=["node", "fp", "sketch", "set"])

    # A node is one collection of shingles: `whole` sums up all of them.
    prints = cut(own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, __k long, __t long, fp long, sketch binary, keys array<long>, whole long, size long").withColumn("node", F.xxhash64("fp", "sketch", "keys", "whole", "size")))
    order = F.struct(F.col("id").isNull().alias("n"), "id", "__t", "__k")
    nodes = cut(prints.groupBy("node", "fp", "sketch", "keys", "size").agg(F.min(order).alias("o")))
    buckets = tiled(nodes.select("node", "fp", "sketch", F.explode("keys").alias("key")), "node", ["key"], tile)
    allowed = similarity - 5 * (similarity * (1 - similarity) / SKETCH) ** 0.5
    near = components(compared(buckets, radius, allowed))
    members = cut(nodes.join(near, "node").select("node", "root", "fp", "sketch", "keys", "size", "o.__k", "o.__t"))

    fits = (F.col("__n") <= tile) & (F.col("__m") <= SHINGLES)
    placed = members.join(members.groupBy("root").agg(F.count("*").alias("__n"), F.sum("size").alias("__m")), "root").select("node", "root", "keys", "size", fits.alias("fits"))
    large = placed.where("not fits").select("node", "root", "size", F.explode("keys").alias("key"))
    groups = placed.where("fits").select("node", F.xxhash64("root", F.lit(2)).alias("g")).unionByName(tiled(large, "node", ["root", "key"], tile, "size").select("node", "g"))
    first = F.row_number().over(Window.partitionBy("__k", "__t").orderBy(F.lit(1)))
    texts = own.select("__k", "__t", "__x").join(members.select("node", "fp", "sketch", "__k", "__t"), ["__k", "__t"]).withColumn("__r", first).where("__r = 1").select("node", "fp", "sketch", "__x")
    sets = texts.mapInArrow(shingle_sets, "node long, fp long, sketch binary, set binary")
    found = components(compared(groups.join(sets, "node"), radius, allowed, similarity))
    rooted = nodes.select("node", "o").join(found, "node", "left").select(F.coalesce("root", "node").alias("root"), "o")
    keep = rooted.groupBy("root").agg(F.min("o").alias("o")).select("o.__k", "o.__t")
    return keyed.join(cut(keep), ["__k", "__t"]).withColumn("__r", first).where("__r = 1").select(*names).toDF(*columns)
