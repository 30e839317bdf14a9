"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stationflow.llm import collocations
from tests.llm.test_llm import SCHEMA

LOWER = {c: c + 32 for c in range(65, 91)}


def expected(rows, least=10, absorbed=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        own = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in own.items():
            if any(len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:]) and 100 * b >= absorbed * a for q, b in own.items()):
                continue
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def texts(seed=2, n=120):
    rng = random.Random(seed)
    words = ["New", "York", "city", "the", "of", "árbol", "日本", "a", "b", "x1", "\x1c", "Ž"]
    rows = [("".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ", ", ".", "\n", " "]) for _ in range(rng.randrange(0, 80))), rng.choice(["en", "fr", None])) for _ in range(n)]
    rows += [(None, "en"), ("", "en"), (" . ,; ", "de"), ("New York City " * 300, "xx"), ("one two " * 9 + "one two", "aa"), ("y y y y y y y y y y y y", "und"), rows[0]]
    return rows


def mined(spark, rows, **more):
    df = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in collocations.mine(df.repartition(3), **more).collect())


@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_counting(spark, monkeypatch, small):
    """Also where tasks hand on their counts in small parts."""
    if small:
        monkeypatch.setattr(collocations, "HELD_CELLS", 500)
        monkeypatch.setattr(collocations, "HELD_PHRASES", 50)
    assert mined(spark, texts()) == expected(texts())


def test_a_full_filter_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(collocations, "places", lambda cell, bits: (cell * 0,))
    assert mined(spark, texts()) == expected(texts())


def test_top_and_ties(spark):
    rows = [("b c. a d. e f. " * 12, "en")]
    assert [r[:3] for r in mined(spark, rows, top=2)] == [("en", 1, "a d"), ("en", 2, "b c")]


def test_summary_keeps_all_that_can_be_frequent():
    rng = np.random.default_rng(0)
    for least in (3, 10):
        cells = np.concatenate([rng.zipf(1.3, 20_000) % 50_000, np.repeat(np.arange(60_000, 60_050), least)])
        rng.shuffle(cells)
        summary = collocations.Summary(len(cells) // least + 1)
        merged = 0
        for part in np.array_split(cells, 60):
            summary.add(*np.unique(part, return_counts=True))
            merged = max(merged, summary.taken)
        left = set(summary.left(least).tolist())
        true, n = np.unique(cells, return_counts=True)
        assert summary.taken < least and len(summary.cells) <= summary.capacity
        assert set(true[n >= least].tolist()) <= left and len(left) < len(true)


def test_cells_are_packed_without_loss():
    rng = np.random.default_rng(1)
    for top in (10, 1 << 16, 1 << 40):
        cells = np.unique(np.concatenate([rng.integers(0, top, 200), [0, 65535 % top, top - 1]]))
        assert (collocations.unpacked(collocations.packed(cells)) == cells).all()
    assert len(collocations.unpacked(collocations.packed(cells[:0]))) == 0


def test_large_counts_are_exact(spark):
    """A product over 64 bits."""
    got = spark.createDataFrame([(10**12 - 1, 10**12 - 3, 10**12)], "a long, l long, r long")
    a, l, r = (f"cast({c} as decimal(18,0))" for c in "alr")
    assert got.selectExpr(f"(cast(1000000 as decimal(7,0)) * {a} * {a}) div ({l} * {r}) AS s").first()[0] == 10**6 * (10**12 - 1) ** 2 // ((10**12 - 3) * 10**12)


def test_empty_table(spark):
    assert collocations.mine(spark.createDataFrame([], SCHEMA)).collect() == []


def test_blocks_are_folded_without_loss_and_small():
    """Sorted phrases of a task take less than half the bytes of their text, whatever their counts."""
    rng = random.Random(3)
    phrases = sorted({" ".join(rng.choice(["the", "of", "river", "árbol", "日本", "x1"]) for _ in range(rng.randrange(1, 7))) for _ in range(3000)})
    n = np.array([rng.choice([1, 1, 2, 255, 256, 10**12]) for _ in phrases])
    phrase = pa.array(["", *phrases], pa.large_string())[1:]
    long, data = collocations.folded(phrase, n)
    got, counts = collocations.unfolded(len(phrases), long, data)
    assert got.to_pylist() == phrases and counts.to_pylist() == n.tolist()
    assert len(data) < sum(len(x.encode()) for x in phrases) / 2
