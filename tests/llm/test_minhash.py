"""MinHash near-duplicates against exact set similarities."""

import random

import numpy as np
import pytest

from stationflow.llm import minhash
from tests.llm.test_llm import SCHEMA, WORD, corpus, frame


def shingle_set(text, k=4):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def groups(texts, percent=80):
    """The least index reachable by links of set similarity, for every text."""
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for j in range(len(sets)):
        for i in range(j):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))], [len(s) for s in sets]


def near_copies(seed=1):
    """Families of texts that differ by a few words, around the threshold, with a passage that unrelated texts share."""
    rng = random.Random(seed)
    some = lambda k: [f"w{rng.randrange(400)}" for _ in range(k)]
    passage, texts = some(40), []
    for size in (5, 8, 30, 60, 120):
        base = some(size)
        for edits in (0, 0, 1, 1, 2, 3, 5):
            own = list(base)
            for _ in range(edits):
                own[rng.randrange(len(own))] = f"x{rng.randrange(1000)}"
            texts.append(" ".join(own))
        texts.append(" ".join(some(size) + passage))
    return texts


@pytest.mark.parametrize("tile", [4096, 3])
def test_groups_equal_exact_similarity(spark, tile):
    """Also with buckets and groups that are dealt to tiles of three sets."""
    texts = corpus() + near_copies() + ["Same Words here now", "same words HERE now", "  same\nwords here now "]
    got = minhash.near_duplicates(frame(spark, texts), tile=tile).collect()
    root, sizes = groups(texts)
    assert len(got) == len(texts) + 2
    for r in got:
        if r["doc_id"] is not None:
            assert (r["component_id"], r["n_shingles"], r["kept"]) == (root[r["doc_id"]], sizes[r["doc_id"]], root[r["doc_id"]] == r["doc_id"])
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, False)]


def test_a_chain_in_one_bucket_is_connected():
    """Neighbours agree, the first and the last don't: the star of the first doesn't reach all, further centres do."""
    rows = np.zeros((40, minhash.BINS), np.uint8)
    for i in range(40):
        rows[i, : 3 * i] = 1
    a, b = minhash.stars(rows, np.full(40, 100), 0.9, 80)
    assert len(a) == 39 and len(set(zip(a.tolist(), b.tolist()))) == 39
    rows[20:] += 7
    a, b = minhash.stars(rows, np.full(40, 100), 0.9, 80)
    assert len(a) == 38 and all((x < 20) == (y < 20) for x, y in zip(a, b))


def test_bins_agree_as_often_as_sets_do():
    """Densified signatures estimate the similarity without bias, for sets smaller and larger than the bins."""
    rng = np.random.default_rng(3)
    for size in (4, 20, 100, 1000):
        shared, alike = size * 8 // 10, []
        for _ in range(60):
            h = rng.integers(0, 1 << 63, 2 * size - shared, dtype=np.uint64) * np.uint64(2)
            both = np.concatenate([h[:size], h[size - shared :]])
            s = minhash.signatures(both, np.array([0, size, 2 * size]))
            alike.append((s[0] == s[1]).mean())
        assert abs(np.mean(alike) - shared / (2 * size - shared)) < 0.05


def test_long_text_and_empty_table(spark):
    long = " ".join(f"w{i * i % 9973}" for i in range(200_000))
    got = minhash.near_duplicates(spark.createDataFrame([(5, long), (9, long + " end"), (7, "a b")], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {5: 5, 9: 5, 7: 7}
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_clashing_names(spark):
    clash = "doc_id long, text string, node long, size int, keys string, sketch string, g long, root long, o int, n int, key long, a long, b long, id long, __k long, __t long, __x string"
    rows = [(i, t, *[1] * 2, "k", "s", *[1] * 10, "x") for i, t in enumerate(["a b c d e f g h i j k l m n", "a b c d e f g h i j k l m n", None])]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, clash)).collect()}
    assert got == {0: 0, 1: 0, 2: 2}
