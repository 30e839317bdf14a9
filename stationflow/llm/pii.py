"""Personal data: fixed patterns, and a semi-Markov conditional random field over whole spans.

The patterns (email, ip, card, phone) are matched exactly as stated in their names below; their spans always stay. The field adds
what they miss: tokens are runs without white space, quotes, = and :, and the text near a trigger (a token with a digit or @, or after a telling
name such as "password") is cut into segments of at most `most_tokens` tokens, each outside or an entity of one type. A segment is scored as a whole by features of its shape (digit count, separators,
checksum, the word before it ...); bounded-entity dynamic programming chooses boundaries and types together. Its types are
those of the patterns, and `secret` (keys, tokens, passwords).

It is trained by likelihood: gradient steps on the forward-backward expectations of at most `sample` distinct trigger regions, labelled by
the patterns and, for secrets, by an assignment to a telling name. Regions are found on the executors, in at most `documents` distinct texts.

Defined results: null text counts as empty and has no span. Offsets are code points, ends exclusive. Repeated rows each give a row. An
empty table gives no rows, and the weights stay zero. Texts are searched whole, and tokens may be of any length. Other columns are passed on by redact() and ignored by find().
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, cut

KINDS = ("email", "ip", "card", "phone")
TYPES = (*KINDS, "secret")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: A match of the plain patterns starts at the head of a run of digits, so looking behind loses none and keeps the search linear.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
SECRET = re.compile(r"""(?i)(?:token|secret|api_?key|passw(?:or)?d|key)["']?\s*[=:]\s*["']?([A-Za-z0-9_+/-]{16,})""")
TOKEN = re.compile(r"[^\x20\x09-\x0D=:\"']+")
TELLING = frozenset(("token", "secret", "key", "apikey", "api_key", "password", "passwd"))
NAMED = re.compile("(?i)token|secret|key|passw")
NAME = re.compile("[a-z_]+")
CONTEXT = 48


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def patterns(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every match that holds."""
    out = [(s, "email", e) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text) if "." in text else ():
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), "ip", m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), "card", m.end()))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((m.start(), "phone", m.end()))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


# ---- the field


class Region:
    """Consecutive tokens around triggers: their bounds in the text, cut free of surrounding punctuation, and the text before the first."""

    def __init__(self, tokens: list[tuple[int, int]], before: str):
        self.tokens, self.before = tokens, before


def bare(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in "(<[{,;":
        start += 1
    while end > start and text[end - 1] in ">]},;.!?#*$%&|":
        end -= 1
    return start, end


def regions(text: str) -> list[Region]:
    """Runs of trigger tokens, each with the characters before it as context."""
    out: list[Region] = []
    if not (DIGIT.search(text) or "@" in text or NAMED.search(text)):
        return out
    run: list[tuple[int, int]] = []
    told = False

    def done():
        out.append(Region(run, text[max(0, run[0][0] - CONTEXT) : run[0][0]]))

    for m in TOKEN.finditer(text):
        token = m[0]
        if told or DIGIT.search(token) or "@" in token:
            run.append(bare(text, m.start(), m.end()))
        elif run:
            done()
            run = []
        told = len(token) < 12 and token.lower() in TELLING
    if run:
        done()
    return out


FEATURES = 64


def features(text: str, region: Region, i: int, j: int) -> list[int]:
    """Numbers of the features that hold for the segment of tokens i to j - 1, as a whole."""
    start, end = region.tokens[i][0], region.tokens[j - 1][1]
    s = text[start:end]
    digits = [c for c in s if "0" <= c <= "9"]
    n, share = len(digits), len(digits) / max(1, len(s))
    prior = (region.before + text[max(region.tokens[0][0], start - CONTEXT) : start])[-CONTEXT:]
    letters = sum(c.isalpha() for c in s)
    on = [0, 1 + min(j - i, 4) - 1]
    on.append(5 + (0 if n == 0 else 1 if n < 7 else 2 if n < 10 else 3 if n < 14 else 4 if n < 16 else 5 if n < 20 else 6))
    on.append(12 + min(3, int(share * 4)))
    on.append(16 + min(5, s.count(".")))
    on.append(22 + min(3, s.count("-")))
    for k, holds in enumerate((
        "@" in s, s.count("@") == 1 and "." in s.partition("@")[2], s.startswith("+"), "(" in s, " " in s, s.isdigit(),
        letters == 0, n >= 14 and letters == 0 and luhn("".join(digits)), len(s) >= 16 and s.isalnum() and letters > 0, len(s) >= 32,
        any(w in TELLING for w in NAME.findall(prior.lower())[-2:]), prior.rstrip(" \"'").endswith(("=", ":")), "=" in s, all(c in "0123456789abcdefABCDEF" for c in s),
        s.count(".") == 3 and s.replace(".", "").isdigit() and all(p and int(p[:4]) <= 255 for p in s.split(".")), s[:1].isalpha(), s[-1:].isalpha(), any(c.isspace() and c != " " for c in s),
    )):
        if holds:
            on.append(26 + k)
    return on


def lattice(text: str, region: Region, most: int) -> list[tuple[int, int, list[int]]]:
    n = len(region.tokens)
    return [(i, j, features(text, region, i, j)) for i in range(n) for j in range(i + 1, min(n, i + most) + 1) if region.tokens[i][0] < region.tokens[j - 1][1]]


def best_segments(text: str, region: Region, weights: np.ndarray, most: int) -> list[tuple[int, str, int]]:
    """Bounded-entity dynamic programming: the best cut of the region into outside tokens (score 0) and typed segments."""
    n = len(region.tokens)
    score, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
    by_start: dict[int, list] = {}
    for i, j, on in lattice(text, region, most):
        s = weights[:, on].sum(axis=1)
        t = int(s.argmax())
        by_start.setdefault(i, []).append((j, t, float(s[t])))
    for i in range(n):
        if score[i] > score[i + 1]:
            score[i + 1], back[i + 1] = score[i], (i, None)
        for j, t, s in by_start.get(i, ()):
            if score[i] + s > score[j]:
                score[j], back[j] = score[i] + s, (i, t)
    out, at = [], n
    while at:
        i, t = back[at]
        if t is not None:
            out.append((region.tokens[i][0], TYPES[t], region.tokens[at - 1][1]))
        at = i
    return out[::-1]


def train(examples: list[tuple[int, list, set]], steps: int = 60, rate: float = 0.3, decay: float = 0.01) -> np.ndarray:
    """Weights (types by features) by gradient ascent on the log-likelihood.

    examples: tokens, lattice, gold segments (i, j, type). The expectations come from forward and backward sums over segmentations.
    """
    w = np.zeros((len(TYPES), FEATURES))
    if not examples:
        return w
    flat = [(e, i, j, on) for e, (_, arcs, _) in enumerate(examples) for i, j, on in arcs]
    x = np.zeros((len(flat), FEATURES))
    gold = np.zeros((len(flat), len(TYPES)))
    for r, (e, i, j, on) in enumerate(flat):
        x[r, on] = 1
        for t in range(len(TYPES)):
            gold[r, t] = (i, j, TYPES[t]) in examples[e][2]
    first = np.searchsorted([f[0] for f in flat], np.arange(len(examples) + 1))
    speed = np.zeros_like(w)
    for step in range(steps):
        scores = np.clip(x @ w.T, -30, 30)
        total = np.exp(scores)
        mass = total.sum(axis=1)
        want = np.zeros_like(gold)
        for e, (n, _, _) in enumerate(examples):
            arcs = range(first[e], first[e + 1])
            f, b = np.zeros(n + 1), np.zeros(n + 1)
            f[0] = b[n] = 1
            ends: list[list] = [[] for _ in range(n + 1)]
            for r in arcs:
                ends[flat[r][2]].append(r)
            for j in range(1, n + 1):
                f[j] = f[j - 1] + sum(f[flat[r][1]] * mass[r] for r in ends[j])
            for j in range(n, 0, -1):
                b[j - 1] += b[j]
                for r in ends[j]:
                    b[flat[r][1]] += mass[r] * b[j]
            for r in arcs:
                want[r] = f[flat[r][1]] * b[flat[r][2]] / f[n] * total[r]
        gradient = (gold - want).T @ x / len(examples) - decay * w / len(examples)
        speed = 0.9 * speed + gradient
        w += rate * speed * 10
    return w


def fit(docs: DataFrame, text: str = "text", sample: int = 1500, documents: int = 20_000, most_tokens: int = 4, most_region: int = 12) -> np.ndarray:
    """Weights from at most `sample` distinct regions of the `documents` distinct texts that come first by a hash."""
    bounded_batches(docs.sparkSession)
    x = F.col(text).cast("string")
    chosen = docs.select(x.alias("x")).where(x.rlike("[0-9@]|(?i)(token|secret|key|passw)")).select("x", F.xxhash64("x").alias("h"))
    few = chosen.select("h").distinct().orderBy("h").limit(documents).agg(F.max("h")).first()[0]

    def run(batches):
        for batch in batches:
            rows = []
            for h, t in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()):
                gold = [(s, k, e) for s, k, e in patterns(t)] + [(m.start(1), "secret", m.end(1)) for m in SECRET.finditer(t)]
                for number, region in enumerate(regions(t)):
                    if len(region.tokens) > most_region:
                        continue
                    lo, hi = region.tokens[0][0], region.tokens[-1][1]
                    own = [(s - lo, k, e - lo) for s, k, e in gold if lo <= s and e <= hi]
                    rows.append((h, number, t[lo:hi], region.before, [a - lo for a, _ in region.tokens], [b - lo for _, b in region.tokens], [k for _, k, _ in own], [s for s, _, _ in own], [e for _, _, e in own]))
            names = ["h", "n", "x", "before", "a", "b", "kind", "s", "e"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    if few is None:
        return np.zeros((len(TYPES), FEATURES))
    found = chosen.where(F.col("h") <= few).dropDuplicates(["h"]).mapInArrow(run, "h long, n long, x string, before string, a array<long>, b array<long>, kind array<string>, s array<long>, e array<long>")
    found = cut(found.dropDuplicates(["x", "before"]))
    mixed = F.xxhash64("x", "before")
    labelled = found.where("size(kind) > 0").orderBy(mixed).limit(sample * 2 // 3)
    others = found.where("size(kind) = 0").orderBy(mixed).limit(sample // 3)
    examples = []
    for r in sorted(labelled.unionByName(others).collect(), key=lambda r: (r["h"], r["n"])):  # at most `sample` short regions
        region = Region(list(zip(r["a"], r["b"])), r["before"])
        starts, ends = {a: i for i, a in enumerate(r["a"])}, {b: i + 1 for i, b in enumerate(r["b"])}
        gold, full = set(), -1
        for s, k, e in sorted(zip(r["s"], r["kind"], r["e"]), key=lambda g: (g[0], TYPES.index(g[1]))):
            if s in starts and e in ends and 0 < ends[e] - starts[s] <= most_tokens and starts[s] >= full:
                gold.add((starts[s], ends[e], k))
                full = ends[e]
        examples.append((len(region.tokens), lattice(r["x"], region, most_tokens), gold))
    return train(examples)


def spans(text: str, weights: np.ndarray | None, most_tokens: int = 4) -> tuple[list, list]:
    """Pattern spans, and all spans: those of the field that touch no pattern span are added."""
    base = patterns(text)
    if weights is None:
        return base, base
    more = []
    for region in regions(text):
        for s, k, e in best_segments(text, region, weights, most_tokens):
            if all(e <= a or s >= b for a, _, b in base):
                more.append((s, k, e))
    return base, sorted(base + more, key=lambda s: (s[0], TYPES.index(s[1]), s[2]))


def find(docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int = 1500) -> DataFrame:
    """doc_id, base (pattern spans) and spans (all), each as kind:start:end joined by commas, the number of pattern spans by kind, of all spans, and of secrets."""
    weights = fit(docs, text, sample)
    own = docs.select(docs[id].alias("doc_id"), docs[text].cast("string").alias("text"))
    names = ["doc_id", "base", "spans", *(f"n_{k}" for k in KINDS), "n_spans", "n_secret"]

    def run(batches):
        for batch in batches:
            got = [spans(t or "", weights) for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(s[1] == k for s in b) for b, _ in got], pa.int64()) for k in KINDS]
            counts += [pa.array([len(a) for _, a in got], pa.int64()), pa.array([sum(s[1] == "secret" for s in a) for _, a in got], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([joined(b) for b, _ in got], pa.string()), pa.array([joined(a) for _, a in got], pa.string()), *counts], names=names)

    bounded_batches(docs.sparkSession)
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, base string, spans string" + "".join(f", {n} long" for n in names[3:]))


def redacted(text: str, found: list[tuple[int, str, int]]) -> str:
    """The text with each span (overlapping ones joined) replaced by its kind in angle brackets."""
    out, at = [], 0
    for s, k, e in found:
        if s >= at:
            out += [text[at:s], f"<{k.upper()}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text", sample: int = 1500) -> DataFrame:
    """docs with every span of its text replaced."""
    weights = fit(docs, text, sample)
    names, at = docs.columns, docs.columns.index(text)

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([t if t is None else redacted(t, spans(t, weights)[1]) for t in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
