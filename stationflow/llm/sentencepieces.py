"""SentencePiece encoding and decoding by a weighted finite-state transducer.

Three machines are compiled from the model file: the normaliser (its rewriting rules, leftmost and longest first, folding of blanks, the dummy
prefix), the pieces and the byte fallback. The normaliser gives one output for each input, so its composition with a text is a string; the escape of blanks
is letter to letter and is composed with the pieces beforehand. The states of what follows are (place in the string, piece read last); an arc reads
the characters of a piece and writes its id, or reads one character and writes the ids of its bytes. The encoding is what the
tropical-semiring shortest path of the composition writes.
- Unigram models: an arc weighs the piece's negative score.
- BPE models: the merges are compiled into the arcs' weights: 0 if merging would leave the two pieces beside each other,
  infinite if not. A cut into pieces is the merges' result just if all its neighbours are so, so one path has a finite weight,
  and one piece ends it at every place: the search keeps a single state a place.
No piece goes on over a blank that follows another character (checked when compiled), so the input is composed run by run,
and a worker keeps the paths of the runs it has met, up to a bound.

Models without byte fallback, with user-defined pieces, or with blanks as suffixes are refused.

Defined results: null and empty texts have no piece. U+2581 in a text is a blank, as in the format itself; all else that the normaliser keeps comes back exactly. Repeated rows
each give a row. An empty table gives no rows. Other columns are ignored. Texts are encoded whole.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches

BLANK = "▁"
#: Fixed values of the model format: kinds of pieces, and of models. Numbers of fields stand where they are read.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
CACHE_RUNS = 900_000
RUN = re.compile(" *[^ ]+| +")


def fields(data: bytes):
    """(number, value) of each field of a serialised message."""

    def varint(i):
        v = shift = 0
        while True:
            c = data[i]
            i, v, shift = i + 1, v | (c & 127) << shift, shift + 7
            if c < 128:
                return v, i

    i = 0
    while i < len(data):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            v, i = varint(i)
        else:
            n, i = varint(i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            v, i = data[i : i + n], i + n
        yield tag >> 3, v


def rewriting_rules(charsmap: bytes) -> dict[bytes, bytes]:
    """The rules of a precompiled map: a double-array trie of sources, whose values are places among the zero-ended replacements."""
    if not charsmap:
        return {}
    (size,) = struct.unpack("<I", charsmap[:4])
    units, texts = np.frombuffer(charsmap[4 : 4 + size], "<u4").tolist(), charsmap[4 + size :]
    offset = lambda u: (u >> 10) << ((u & 1 << 9) >> 6)
    out, stack = {}, [(offset(units[0]), b"")]
    while stack:
        base, source = stack.pop()
        for c in range(1, 256):
            at = base ^ c
            if at < len(units) and units[at] & (1 << 31 | 255) == c:
                below = at ^ offset(units[at])
                if units[at] >> 8 & 1:
                    start = units[below] & (1 << 31) - 1
                    out[source + bytes([c])] = texts[start : texts.index(0, start)]
                stack.append((below, source + bytes([c])))
    return out


class Normaliser:
    """A text's normal form, with blanks as spaces: rules apply leftmost and longest first, all else is copied."""

    def __init__(self, spec: dict):
        self.prefix, self.fold = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if not spec.get(5, 1):
            raise ValueError("models that don't escape blanks are not compiled")
        rules = {k.decode(): v.decode() for k, v in rewriting_rules(spec.get(2, b"")).items()}
        self.longest, self.rules = max(map(len, rules), default=0), rules
        self.letters = str.maketrans({k: v for k, v in rules.items() if len(k) == 1}) if self.longest == 1 else None

    def rewritten(self, text: str) -> str:
        if not self.longest:
            return text
        if self.letters is not None:
            return text.translate(self.letters)
        out, at = [], 0
        while at < len(text):
            for n in range(min(self.longest, len(text) - at), 0, -1):
                if (new := self.rules.get(text[at : at + n])) is not None:
                    out.append(new)
                    at += n
                    break
            else:
                out.append(text[at])
                at += 1
        return "".join(out)

    def __call__(self, text: str) -> str:
        text = self.rewritten(text)
        if self.fold:  # before U+2581 counts as a blank: only true spaces are folded
            text = re.sub("  +", " ", text).strip(" ")
        text = text.replace(BLANK, " ")
        return " " + text if self.prefix and text else text


class Transducer:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            parts = list(fields(f.read()))
        pieces = [dict(fields(v)) for n, v in parts if n == 1]
        trainer = dict(fields(next(v for n, v in parts if n == 2)))
        self.normal = Normaliser(dict(fields(next((v for n, v in parts if n == 3), b""))))
        self.kind = trainer.get(3, UNIGRAM)
        if self.kind not in (UNIGRAM, BPE) or not trainer.get(35, 0) or trainer.get(24, 0) or any(p.get(3, NORMAL) == USER for p in pieces):
            raise ValueError("only unigram and BPE models with byte fallback are compiled, without user-defined pieces or blanks as suffixes")
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.bytes: list[int] = [0] * 256
        self.out: list[bytes] = []
        for i, p in enumerate(pieces):
            text, kind = p[1].decode(), p.get(3, NORMAL)
            if kind == NORMAL:  # the escape of blanks is undone: pieces read spaces
                self.score[text.replace(BLANK, " ")] = struct.unpack("<f", p[2])[0] if 2 in p else 0.0
                self.id[text.replace(BLANK, " ")] = i
            if kind == BYTE:
                self.bytes[int(text[3:5], 16)] = i
            self.out.append(bytes([int(text[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else text.replace(BLANK, " ").encode())
        if any(" " in p.lstrip(" ") for p in self.id):
            raise ValueError("a piece goes on over a blank")
        self.text = {i: p for p, i in self.id.items()}
        self.written = [struct.pack("<I", i) for i in range(len(pieces))]  # what the arcs of pieces write
        self.floor = min(self.score.values()) - 10
        self.spelled: dict[str, bytes] = {}  # what the arcs of the byte fallback write, compiled when first met
        self.beside: dict[int, bool] = {}
        self.paths: dict[str, bytes] = {}  # by run
        self.words: dict[str, bytes] = {}  # by what follows a single blank
        self.arcs = ahocorasick.Automaton()  # all pieces at once, by where they end
        for p, i in self.id.items():
            self.arcs.add_word(p, (len(p), i))
        self.arcs.make_automaton()
        self.parts: dict[str, tuple[str, str] | None] = {}

    def fallback(self, character: str) -> bytes:
        if character not in self.spelled:
            own = (BLANK if character == " " else character).encode(errors="surrogatepass")
            self.spelled[character] = b"".join(self.written[self.bytes[b]] for b in own)
        return self.spelled[character]

    def merged(self, text: str, halves: bool = False) -> list[str]:
        """The pieces that merging by score, leftmost first, makes of a text; with halves, the two before the last merge. Only used to compile weights."""
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(text) - 1)), list(range(1, len(text) + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i, j):
            if i >= 0 and j < len(parts) and (both := parts[i] + parts[j]) in self.score:
                heapq.heappush(heap, (-self.score[both], i, j, both))

        for i in range(len(text) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or right[i] != j or parts[i] + parts[j] != both:
                continue
            if halves and both == text:
                return [parts[i], parts[j]]
            parts[i], parts[j] = both, None
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        out = [p for p in parts if p is not None]
        return [] if halves else out

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes the piece; None for a single character."""
        if piece not in self.parts:
            whole = self.merged(piece, halves=True) if len(piece) > 1 else None
            self.parts[piece] = tuple(whole) if whole else None
        return self.parts[piece]

    def weight(self, a: int, b: int) -> bool:
        """Is the weight of b's arc from a state whose last piece is a finite (BPE)?

        Merges are undone from the last on, on either side of the border; the weight is infinite if, at a time when both parts beside the border
        exist, their merge has a better score than what comes next there (at equal scores the left one comes first).
        """
        known = self.beside.get(a << 32 | b)
        if known is None:
            if len(self.beside) > 3_000_000:
                self.beside.clear()
            left, right = self.text[a], self.text[b]
            known = self.beside[a << 32 | b] = self.finite(left, right)
        return known

    def finite(self, left: str, right: str) -> bool:
        score, late = self.score, (float("inf"), 0)  # a merge's score, and its place: left of the border 0, across 1, right 2
        rank = lambda p: -score[p] if len(p) > 1 else float("-inf")
        while True:
            both = left + right
            if both in score and (-score[both], 1) < late:
                return False
            if rank(left) > rank(right):
                late, left = (rank(left), 0), self.split(left)[1]
            elif len(right) > 1:
                late, right = (rank(right), 2), self.split(right)[0]
            else:
                return True

    def shortest(self, run: str) -> bytes:
        """What the shortest path for one run writes: ids, little-endian 32-bit."""
        n = len(run)
        last, size = [-1] * (n + 1), [1] * (n + 1)  # the arc that ends at each place: a piece, or -1, the byte fallback of one character
        if self.kind == BPE:
            beside, weight = self.beside, self.weight
            for end, (k, i) in self.arcs.iter(run):
                at = end + 1 - k
                if last[end + 1] < 0:
                    before = last[at]
                    if not at or before < 0:
                        last[end + 1], size[end + 1] = i, k
                    else:
                        known = beside.get(before << 32 | i)
                        if weight(before, i) if known is None else known:
                            last[end + 1], size[end + 1] = i, k
        else:
            ends: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
            for end, arc in self.arcs.iter(run):
                ends[end + 1].append(arc)
            cost = [0.0] + [float("inf")] * n
            for j in range(1, n + 1):
                cost[j] = cost[j - 1] - self.floor
                for k, i in ends[j]:
                    c = cost[j - k] - self.score[self.text[i]]
                    if c < cost[j]:
                        cost[j], last[j], size[j] = c, i, k
        out, j = [], n
        while j:
            out.append(self.written[last[j]] if last[j] >= 0 else self.fallback(run[j - 1]))
            j -= size[j]
        return b"".join(reversed(out))

    def encode(self, text: str) -> bytes:
        text = self.normal(text)
        if not text:
            return b""
        plain = "  " not in text and text[0] == " "
        known, head = (self.words, " ") if plain else (self.paths, "")
        runs = text[1:].split(" ") if plain else RUN.findall(text)
        parts = list(map(known.get, runs))
        if None in parts:
            if len(known) > CACHE_RUNS:
                known.clear()
            for i, p in enumerate(parts):
                if p is None:
                    parts[i] = known[runs[i]] = self.shortest(head + runs[i])
        return b"".join(parts)

    def decode(self, ids) -> str:
        data = b"".join(map(self.out.__getitem__, ids))
        return (data[1:] if self.normal.prefix and data[:1] == b" " else data).decode(errors="replace")

    def plain(self, text: str) -> str:
        """What decoding gives back."""
        text = self.normal(text)
        return text[1:] if self.normal.prefix else text


_compiled: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array) of every text."""
    own = docs.select(docs[id].alias("doc_id"), docs[text].cast("string").alias("text"))

    def run(batches):
        model = transducer(path)
        for batch in batches:
            got = [model.encode(t or "") for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *(len(g) // 4 for g in got)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(got), "<u4").astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    bounded_batches(docs.sparkSession)
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row of ids; null ids give null."""

    def run(batches):
        model = transducer(path)
        for batch in batches:
            texts = [None if i is None else model.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    bounded_batches(encoded.sparkSession)
    own = encoded.select("doc_id", "ids")
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_pieces, n_bytes (pieces of the byte fallback), ids_crc32, decoded_same: encodes and decodes every text, without shipping the ids."""
    own = docs.select(docs[id].alias("doc_id"), docs[text].cast("string").alias("text"))
    names = ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "decoded_same"]

    def run(batches):
        model = transducer(path)
        byte = np.zeros(len(model.out), bool)
        byte[model.bytes] = True
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                data = model.encode(t or "")
                ids = np.frombuffer(data, "<u4")
                rows.append((len(ids), int(byte[ids].sum()), zlib.crc32(data), model.decode(ids.tolist()) == model.plain(t or "")))
            n, b, crc, same = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(b, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], names=names)

    bounded_batches(docs.sparkSession)
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, n_pieces long, n_bytes long, ids_crc32 long, decoded_same boolean")
