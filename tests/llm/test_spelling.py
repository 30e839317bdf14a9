"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from stationflow.llm import spelling
from tests.llm.test_llm import SCHEMA

LOWER = {c: c + 32 for c in range(65, 91)}


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows, drop=31):
    counts = Counter()
    for key, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if drop and h % drop == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    n = {w: c for w, c in counts.items() if c >= 2}
    near = {w: [v for v in n if distance_one(w, v)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if n[v] >= 10 * n[w]}
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def found(spark, rows, schema="doc_id long, text string", **more):
    got = spelling.group(spark.createDataFrame(rows, schema), **more).collect()
    assert len({r["word"] for r in got}) == len(got)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}


def texts(seed=4):
    """Words over a small alphabet, so that many are near, with repeated letters (several edits give one word), and a chain of forms."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aabé") for _ in range(rng.randrange(7, 11))) for _ in range(250)]
    words += ["Straßenbahn", "strassenbahn", "straßenbahnen", "ÀÉÎõü×÷", "ÀÉÎõü×÷s", "x" * 400, "x" * 401, "x" * 200 + "y" + "x" * 199]
    chain = ["received"] * 250 + ["recieved"] * 22 + ["recievd"] * 2 + ["receivedd"] * 20
    rows = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(40)]
    return [*rows, (100, ", ".join(chain)), (101, None), (102, ""), (103, "short words only 123456789"), (None, "without identity " * 3), rows[0], (104, "Straßenbahn-straßenBahn_" + "x" * 400 + "1" + "x" * 401)]


@pytest.mark.parametrize("tile", [1 << 16, 5])
def test_equals_all_pairs(spark, tile):
    """Also with groups that are dealt to tiles of five words."""
    assert found(spark, texts(), tile=tile) == expected(texts())
    assert found(spark, texts(), tile=tile, drop=0) == expected(texts(), 0)


def test_roots_follow_chains(spark):
    got = found(spark, [(1, " ".join(["abcdefgh"] * 1000 + ["abcdefgi"] * 100 + ["abcdefji"] * 10 + ["abcdkfji"] * 10))], drop=0)
    assert got["abcdefji"][:2] == ("abcdefgi", "abcdefgh") and got["abcdefgi"][:2] == ("abcdefgh", "abcdefgh") and got["abcdkfji"][:2] == (None, "abcdkfji")


def test_ties_take_the_least_word(spark):
    got = found(spark, [(1, " ".join(["baaaaaaa", "caaaaaaa"] * 30 + ["aaaaaaa"] * 3))], drop=0)
    assert got["aaaaaaa"] == ("baaaaaaa", "baaaaaaa", 3, 2, 30)


def test_small_batches_of_counts_and_text(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    monkeypatch.setattr(spelling, "PIECE", 50)
    own = spark.createDataFrame(texts(), "doc_id long, text string")
    want = {w: x[2] for w, x in expected(texts()).items()}
    assert {r["word"]: r["n"] for r in spelling.vocabulary(own).collect()} == want


def test_empty_and_clashing(spark):
    assert spelling.group(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = "doc_id long, text string, word string, n long, root string, g long, at int, own boolean, tail string, x string, id long, near long"
    rows = [(1, "exactly exactly exactely exactely", "w", 1, "r", 1, 1, True, "t", "x", 1, 1)]
    assert found(spark, rows, clash, drop=0) == expected([(1, "exactly exactly exactely exactely")], 0)
    with pytest.raises(ValueError):
        spelling.group(spark.createDataFrame([], SCHEMA), least=5)
