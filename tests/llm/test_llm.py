"""The training-data operators against brute force, on small tables with the awkward cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from stationflow.llm import langid, licenses, lm, neighbours, packing, pii, quality, sentencepieces, simhash, substring
from stationflow.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, h long, sequence_id int"


def corpus(seed=0, n=60):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma,", "delta", "épée", "日本", "the", "of", "x1", "and"]
    some = lambda k: " ".join(rng.choice(words) + str(rng.randrange(30)) for _ in range(k))
    passage = some(60)
    texts = [some(rng.randrange(0, 120)) for _ in range(n)]
    texts += [None, "", "   \n\t ", "one", "two words", some(3000), texts[3], texts[3], texts[3] + " end", some(20) + "\n" + passage + " " + some(5), passage + " " + some(30), "a  b\n\nc d"]
    return texts


def frame(spark, texts, langs=None):
    rows = [(i, t, langs[i] if langs else "en", "s", 0, "clash", 1, 2) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "no id here", None, None, None, None, None, None)]  # a repeated row and a null id
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return frame(spark, texts)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def fingerprint(text, k):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (3, 1), (10, 1)], "a long, b long")
    assert sorted(tuple(r) for r in components(edges).collect()) == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 7), (10, 1)]
    assert components(edges.limit(0)).count() == 0


def test_simhash_fingerprints_and_groups(docs, empty):
    got = simhash.near_duplicates(docs, radius=12, blocks=14).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len(got) == len(rows)
    fps = {i: fingerprint(t, 3) for i, t in rows}
    assert all(r["fp"] % 2**64 == fps[r["doc_id"]] for r in got)
    parent = {f: f for f in fps.values()}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in parent:
        for b in parent:
            if (a ^ b).bit_count() <= 12:
                parent[find(a)] = find(b)
    least = {}
    for i, f in fps.items():
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    assert all(r["component_id"] == least.get(find(fps[r["doc_id"]])) for r in got)
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_tiles_lose_no_link(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(3)]
    fps = sorted({b ^ (1 << rng.randrange(40)) for b in base for _ in range(60)})
    df = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp long")
    roots = lambda tile: {tuple(sorted(v)) for v in group(components(simhash.links(df, 3, 6, tile)).collect()).values()}
    assert roots(4096) == roots(8) and len(roots(8)) == 3


def group(rows):
    out = collections.defaultdict(list)
    for r in rows:
        out[r["root"]].append(r["node"])
    return out


def test_near_copies_leave_one(spark, docs, texts, empty):
    kept = [r["doc_id"] for r in simhash.deduplicate(docs).collect()]
    assert len(kept) == len(set(kept)) and 3 in kept and not {66, 67, 68} & set(kept)
    assert simhash.deduplicate(docs).columns == docs.columns and simhash.deduplicate(empty).count() == 0


def like(rng, i, n, similarity):
    """Two texts of n five-word shingles at least, whose sets share about `similarity`, and the exact figure."""
    words = [f"w{i}x{rng.randrange(10**6)}" for _ in range(n)]
    other, left = list(words), round(n * (1 - similarity) / (1 + similarity) / 5)
    for at in rng.sample(range(2, n // 6), left):
        other[6 * at] = f"v{i}x{rng.randrange(10**6)}"
    sets = [{tuple(w[j : j + 5]) for j in range(n - 4)} for w in (words, other)]
    return " ".join(words), " ".join(other), len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_unlike_texts_are_kept(spark, monkeypatch):
    rng = random.Random(11)
    pairs = [like(rng, i, n, s) for i, (n, s) in enumerate((n, s) for n in (150, 500, 1000) for s in (0.5, 0.6, 0.7, 0.78, 0.9) for _ in range(6))]
    docs = frame(spark, [t for a, b, _ in pairs for t in (a, b)])
    want = {j for i, (_, _, s) in enumerate(pairs) for j in (2 * i, 2 * i + 1) if s < 0.8 or j % 2 == 0} | {None}
    assert len(want) == 1 + 4 * 3 * 6 * 2 + 3 * 6
    got = [r["doc_id"] for r in simhash.deduplicate(docs).collect()]
    assert len(got) == len(set(got)) and not {j for j in want if j is not None} - set(got)
    monkeypatch.setattr(simhash, "SHINGLES", 2000)
    assert sorted(map(str, got)) == sorted(str(r["doc_id"]) for r in simhash.deduplicate(docs, tile=2).collect())


def test_near_copies_far_in_bits_are_linked(spark):
    rng = random.Random(12)
    made = (like(rng, i, 100, 0.81) for i in range(10**6))
    far = (p for p in made if p[2] >= 0.8 and (fingerprint(p[0], 5) ^ fingerprint(p[1], 5)).bit_count() > 14)
    docs = frame(spark, [t for _ in range(4) for t in next(far)[:2]])
    assert sorted(str(r["doc_id"]) for r in simhash.deduplicate(docs).collect()) == ["0", "2", "4", "6", "None"]


@pytest.mark.parametrize("window,k", [(35, 8), (5, 3)])
def test_substring_against_brute_force(docs, empty, window, k):
    rows = [(r["doc_id"], WORD.findall(r["text"] or "")) for r in docs.collect()]
    seen = collections.Counter(tuple(w[i : i + window]) for _, w in rows for i in range(len(w) - window + 1))
    want = collections.Counter()
    for i, w in rows:
        gone = {j for s in range(len(w) - window + 1) if seen[tuple(w[s : s + window])] > 1 for j in range(s, s + window)}
        want[i, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()] += 1
    got = collections.Counter(tuple(r) for r in substring.measure(docs, window, k).collect())
    assert got == want
    assert substring.measure(empty, window, k).count() == 0
    again = substring.remove(docs, window, k)
    assert again.columns == docs.columns
    left = collections.Counter((r["doc_id"], hashlib.sha256(" ".join(WORD.findall(r["text"] or "")).encode()).hexdigest()) for r in again.collect())
    assert left == collections.Counter({(i, sha): c for (i, _, _, sha), c in want.items()})
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    untouched = {i for (i, _, gone, _) in want if not gone}
    assert untouched and all(r["text"] == whole[r["doc_id"]] for r in again.collect() if r["doc_id"] in untouched)


def test_substring_hot_keys_lose_nothing(spark, docs, monkeypatch):
    """A table of very frequent keys, of whatever bound, changes no result; near copies give anchors with many spans."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(45)]
    made = []
    for i in range(40):
        words = list(passage)
        words[rng.randrange(45)] = f"x{i % 7}"
        made.append(" ".join([*(f"a{rng.randrange(9)}" for _ in range(i % 5)), *words, *(f"b{rng.randrange(9)}" for _ in range(i % 3))]))
    table = frame(spark, made + corpus(3, 20))
    rows = [(r["doc_id"], WORD.findall(r["text"] or "")) for r in table.collect()]
    for window, k in ((12, 4), (35, 8)):
        seen = collections.Counter(tuple(w[i : i + window]) for _, w in rows for i in range(len(w) - window + 1))
        want = collections.Counter()
        for i, w in rows:
            want[i, len(w), len({j for s in range(len(w) - window + 1) if seen[tuple(w[s : s + window])] > 1 for j in range(s, s + window)})] += 1
        for keys, places in ((4096, 1000), (4096, 2), (3, 5), (1, 2)):
            monkeypatch.setattr(substring, "HOT_KEYS", keys)
            monkeypatch.setattr(substring, "HOT_PLACES", places)
            assert collections.Counter(tuple(r)[:3] for r in substring.measure(table, window, k).collect()) == want, (window, keys, places)


def test_packing_exact_and_full(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, path).collect()
    ids = {r["doc_id"]: np.array(own.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4") for r in docs.collect()}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["length"] for r in rows) == sum(len(ids[r["doc_id"]]) for r in docs.collect())
    assert packing.pack_documents(empty, path).count() == 0


def test_packing_encoder_equals_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, fast = Tokenizer.from_file(path), packing.Encoder(path)
    odd = ["", "  a", "a  b", " a\n b \n\n c", "x\n  y", "<|endoftext|> hi", "a <|endoftext|>  b", "<|endoftext|>", "<|endoftext |>", "don't  stop", "\t\n a \t b", "   ", "a ", "日本 語 🙂", "\r\n \r\n x", "  a  b"]
    for t in odd + [t for t in corpus(4) if t]:
        assert np.frombuffer(fast(t), "<u4").tolist() == own.encode(t, add_special_tokens=False).ids, t


def test_inverse_by_rows():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 128):
        m = rng.integers(0, 5, (n, n)) + 3 * np.eye(n, dtype=int)
        assert np.abs((packing.inverted(m)[:, :, None] * m[None]).sum(axis=1) - np.eye(n)).max() < 1e-8
    assert packing.inverted(np.ones((3, 3))) is None


def test_cutting_stock_fill(spark):
    rng = np.random.default_rng(0)
    lengths = np.minimum(np.maximum(1, rng.lognormal(6.6, 1.1, 4000).astype(int)), 2040)
    demand = np.bincount((lengths + 15) // 16 - 1, minlength=128)
    patterns = packing.rounded(demand, packing.solve(demand))
    assert (sum(p * n for p, n in patterns) == demand).all()
    assert lengths.sum() / (2048 * sum(n for _, n in patterns)) > 0.97
    assert packing.solve(np.zeros(8, np.int64)) == [] and packing.rounded(np.zeros(8, np.int64), []) == []


def test_quality_counts_against_brute_force(docs, empty):
    for r in quality.statistics(docs.select("doc_id", "text", "source", "h"), keep=("doc_id", "h")).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        t = r["text"] or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        c = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again))
    assert quality.statistics(empty).count() == 0


def test_decision_list_learns_and_keeps(spark, empty):
    good = [" ".join(f"word{(i * 7 + j * j) % 997}" for j in range(80)) for i in range(150)]
    bad = [" ".join(f"w{(i + j * j) % 991}$$$" for j in range(80)) for i in range(50)]
    docs = frame(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(200)] + [(1, None), (2, 7)], "doc_id long, quality int")
    kept = {r["doc_id"] for r in quality.keep_good(docs, labels).collect()}
    assert kept == {*range(150), None}
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count() and quality.keep_good(empty, labels).count() == 0


def test_pii_patterns_against_plain_expressions():
    rng = random.Random(3)
    bits = ["a.b@c.d", "@", "x@y", "+1 (555) 123-4567", "4111 1111 1111 1111", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "012.0.00.1", ".", "-", " ", "ü", "4111-1111-1111-1111", "+", "12345678901234567890", "b@c.d@e.f", "a@b.c.", "\n"]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 8)))
        want = [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        want += [(m.start(), "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            d = re.sub("[ -]", "", m[0])
            if 14 <= len(d) <= 19 and sum((n := int(c) * (1 + i % 2)) - 9 * (n > 9) for i, c in enumerate(d[::-1])) % 10 == 0:
                want.append((m.start(), "card", m.end()))
        want += [(m.start(), "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        assert pii.patterns(t) == sorted(want, key=lambda s: (s[0], pii.KINDS.index(s[1]), s[2])), t


def test_pii_field_learns_secrets(spark, empty):
    rng = random.Random(5)
    texts = [f'some words {i} token = "{rng.getrandbits(160):040x}" and mail u{i}@ex{i}.org or {rng.randrange(256)}.1.2.3 in {rng.randrange(2000)}' for i in range(200)]
    found = pii.find(frame(spark, texts + [None, ""])).collect()
    spans = {r["doc_id"]: r["spans"] for r in found}
    assert sum("secret:" in spans[i] for i in range(200)) > 190 and all("email:" in spans[i] and "ip:" in spans[i] for i in range(200))
    assert spans[200] == spans[201] == "" and len(found) == 204
    out = {r["doc_id"]: r["text"] for r in pii.redact(frame(spark, texts)).collect()}
    assert "<EMAIL>" in out[0] and "@" not in out[0]
    assert pii.find(empty).count() == 0


def test_pii_field_finds_long_and_inline_secrets(spark):
    rng = random.Random(6)
    key = lambda n: f"{rng.getrandbits(4 * n):0{n}x}"
    texts = [f"some words {i} token = \"{key(40)}\" and {rng.randrange(2000)}" for i in range(100)] + [f"api_key={key(24)} then {i} words" for i in range(100)]
    texts += [f"password: {key(300)} end", f"x token='{key(32)}' y", "the key point 12 is plain"]
    secret = {r["doc_id"]: (r["spans"], r["n_secret"]) for r in pii.find(frame(spark, texts)).collect()}
    assert sum(secret[i][1] == 1 for i in range(200)) > 190
    assert secret[200] == ("secret:10:310", 1) and secret[201] == ("secret:9:41", 1) and secret[202] == ("", 0)


def test_pii_field_against_all_segmentations():
    """The best cut and the expectations of training, against an enumeration of every segmentation."""
    rng = np.random.default_rng(3)
    text = "a1 b2-3 +44 x@y.z 77.1.2.3 9"
    region = pii.Region([(m.start(), m.end()) for m in pii.TOKEN.finditer(text)], "key = ")
    arcs = {(i, j): on for i, j, on in pii.lattice(text, region, 3)}
    n = len(region.tokens)

    def every(at=0):
        if at == n:
            yield ()
            return
        for rest in every(at + 1):
            yield rest
        for j in range(at + 1, min(n, at + 3) + 1):
            for rest in every(j):
                for t in range(len(pii.TYPES)):
                    yield ((at, j, t), *rest)

    for _ in range(3):
        w = rng.normal(-0.3, 0.5, (len(pii.TYPES), pii.FEATURES))
        score = lambda cut: sum(w[t, arcs[i, j]].sum() for i, j, t in cut)  # noqa: B023, E731
        best = max(every(), key=score)
        got = pii.best_segments(text, region, w, 3)
        assert got == [(region.tokens[i][0], pii.TYPES[t], region.tokens[j - 1][1]) for i, j, t in best]
    # One step from zero weights: every segmentation is equally likely, so the expectations are plain shares.
    gold = {(0, 1, "secret"), (3, 4, "email")}
    cuts = list(every())
    want = np.zeros_like(w)
    for i, j, t in (s for c in cuts for s in c):
        want[t, arcs[i, j]] += 1 / len(cuts)
    for i, j, k in gold:
        want[pii.TYPES.index(k), arcs[i, j]] -= 1
    got = pii.train([(n, [(i, j, on) for (i, j), on in arcs.items()], gold)], steps=1, rate=0.1)
    assert np.abs(got + want).max() < 1e-9


def test_language_decoding_against_brute_force(spark):
    """Predictions and scores from the model's numbers, by plain loops over texts, n-grams, bits and languages."""
    rng = random.Random(4)
    words = {"aa": "the of and with", "bb": "der die und nicht", "cc": "les des une pour", "dd": "que los con para", "ee": "och att det som", "ff": "ja on ei ole", "gg": "nie jest to na"}
    langs = [rng.choice(list(words)) for _ in range(200)]
    texts = [" ".join(rng.choice(words[x].split()) for _ in range(rng.randrange(1, 9))) for x in langs] + ["The Of, DER die", "é", "zz"]
    docs = frame(spark, texts, langs + ["aa"] * 3)
    model = langid.fit(docs, F.lit(True))
    assert model.languages == sorted(words)
    for r in langid.predict(docs, model).collect():
        data = ("no id here" if r["doc_id"] is None else texts[r["doc_id"]]).encode().lower()
        x = np.zeros(langid.DIMENSIONS)
        for k in (1, 2, 3):
            for i in range(len(data) - k + 1):
                gram = data[i] + 1
                for c in data[i + 1 : i + k]:
                    gram = gram * 257 + c + 1
                x[(gram * 2654435761 & 0xFFFFFFFF) >> 21] += 1
        x = np.sqrt(x / x.sum())
        loss = []
        for i in range(len(model.languages)):
            per_bit = [math.log1p(math.exp(-(float((x * model.weights[:, b]).sum()) + model.bias[b]) * model.code[i, b])) * model.trust[i, b] for b in range(model.code.shape[1])]
            loss.append(sum(per_bit) * len(per_bit))
        p = [math.exp(min(loss) - v) for v in loss]
        assert r["lang_pred"] == model.languages[loss.index(min(loss))] and abs(r["score"] - max(p) / sum(p)) < 1e-4


def test_language_codes(spark, empty):
    rng = random.Random(2)
    make = {"aa": "the of and with", "bb": "der die und nicht", "cc": "les des une pour"}
    langs = [rng.choice(list(make)) for _ in range(300)]
    texts = [" ".join(rng.choice(make[x].split()) for _ in range(20)) for x in langs]
    docs = frame(spark, texts + [None, "123", ""], langs + ["aa", None, "bb"]).withColumn("held", langid.held_out(F.col("doc_id"), 0))
    got = {r["doc_id"]: r for r in langid.predict(docs, langid.fit(docs, ~F.col("held"))).collect()}
    assert all(got[i]["lang_pred"] == langs[i] and 0 <= got[i]["score"] <= 1 for i in range(300))
    assert [got[i]["lang_pred"] for i in (300, 301, 302)] == ["und"] * 3 and got[300]["score"] == 0
    assert langid.predict(empty, langid.fit(empty, F.lit(True))).count() == 0
    assert langid.predict(docs, None).where("lang_pred <> 'und'").count() == 0


def test_codewords_differ():
    for k in (2, 3, 4, 6, 9, 40):
        assert len({tuple(r) for r in langid.codewords(k)}) == k


def test_lm_base_counts_and_gain(spark, empty):
    rng = random.Random(7)
    texts = [" ".join(f"a{(start + j) % 20}" for j in range(30)) for start in (rng.randrange(20) for _ in range(300))] + [None, "", "UNSEEN word", "A1 a1"]
    docs = frame(spark, texts).withColumn("held_out", langid.held_out(F.col("doc_id"), 1))
    rows = lm.score(docs, ~F.col("held_out"), keep=("held_out",), head=50).collect()
    tokens = lambda t: WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)})) + [None]
    c = collections.Counter()
    for r in docs.collect():
        if not r["held_out"]:
            c.update(tokens(r["text"]))
    total, kinds = sum(c.values()), len(c)
    assert len(rows) == docs.count()
    for r in rows:
        w = tokens("no id here" if r["doc_id"] is None else texts[r["doc_id"]])
        want = sum(math.log10((c[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), total) and abs(r["base_score"] - want) < 1e-8
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert lm.score(empty.withColumn("held_out", F.lit(False)), F.lit(True)).count() == 0


def test_lm_scores_against_plain_loops(spark):
    """Every score from the trained numbers, by loops over tokens, features and classes; the words of a class share all of its mass."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["the", "of", "and", "a"]) if rng.random() < 0.4 else f"{rng.choice('abcd')}{rng.randrange(40)}x" for _ in range(rng.randrange(0, 60))) for _ in range(60)] + [None, "Unseen WORDS here"]
    docs = frame(spark, texts).withColumn("held_out", langid.held_out(F.col("doc_id"), 1))
    training = docs.where("not held_out").select(F.col("text").alias("__x"))
    shared, rest = lm.learn_head(training, 50, 20)
    words, tail = shared.value, {r["h"]: r["c"] for r in rest.collect()}
    w = lm.train(training, shared, lm.LEAST_BUCKETS)
    held = {int(h): (int(c), int(k), int(r)) for h, c, k, r in zip(words.h, words.counts, words.cls, words.rank)}
    mass = [0.5] * lm.CLASSES
    for c, k, _ in held.values():
        mass[k] += c
    spelled = {}
    for t in [*texts, "no id here"]:
        spelled |= {int(h): int(e) for h, e in zip(*lm.tokens(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))[:2])}
    for h, c in tail.items():
        mass[words.by_spelling[spelled[h]]] += c + 0.5
    assert np.abs(np.array(mass) - words.size).max() < 1e-9

    def mix(x):
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> shift) * times % 2**64
        return x ^ x >> 31

    for r in lm.score(docs, ~F.col("held_out"), head=50, core=20).collect():
        data = ("no id here" if r["doc_id"] is None else texts[r["doc_id"]] or "").encode()
        h, e, _ = lm.tokens(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        past, total = [words.start] * 3, 0.0
        for x, spelling in zip(h.tolist(), e.tolist()):
            c, k, rank = held.get(x, (None, int(words.by_spelling[spelling]), 99))
            w1, w2, w3 = past
            on = [mix(v + 1) % lm.LEAST_BUCKETS for v in (w1, (w1 << 24) ^ w2 ^ 1 << 60, w2 ^ 2 << 60, w3 ^ 3 << 60)]
            z = [float(w.bias[i]) + sum(float(w.table[b, i]) for b in on) for i in range(lm.CLASSES)]
            total += (z[k] - math.log(sum(map(math.exp, z)))) / math.log(10) + math.log10((c if c is not None else tail.get(x, 0) + 0.5) / words.size[k])
            past = [rank if rank < 20 else 20 + k, w1, w2]
        assert abs(total - r["score"]) < 1e-3


def test_fingerprints_in_slices_are_those_of_whole_texts(monkeypatch):
    rng = random.Random(3)
    texts = ["", "one", "Two  words", " ", *(" ".join(rng.choice("abcdefG") * rng.randrange(1, 4) for _ in range(rng.randrange(0, 90))) for _ in range(40)), ""]
    data = [t.encode() for t in texts]
    buf, offs = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    for size in (1, 7, 64, 1 << 18):
        monkeypatch.setattr(simhash, "SLICE", size)
        assert [int(x) for x in simhash.text_fingerprints(buf, offs, 3)] == [fingerprint(t, 3) for t in texts]
    assert len(simhash.text_fingerprints(buf[:0], np.array([0]), 3)) == 0


def test_lm_scores_do_not_depend_on_the_split(spark):
    rng = random.Random(5)
    common = [f"w{i}" for i in range(60)]
    texts = [" ".join(common[(start + j * j) % 60] if rng.random() < 0.8 else f"r{rng.randrange(500)}" for j in range(rng.randrange(5, 80))) for start in (rng.randrange(60) for _ in range(400))] + ["same words again"] * 50
    docs = frame(spark, texts).withColumn("held_out", langid.held_out(F.col("doc_id"), 1))
    per = {n: {r["doc_id"]: r for r in lm.score(docs.repartition(n), ~F.col("held_out"), head=300, core=100, keep=("held_out",)).collect()} for n in (1, 8, 64)}
    for n in (8, 64):
        assert all(abs(r["score"] - per[1][i]["score"]) < 1e-6 * r["n_tokens"] for i, r in per[n].items())
    held = [r for r in per[64].values() if r["held_out"]]
    assert sum(r["score"] - r["base_score"] for r in held) > 0.1 * sum(r["n_tokens"] for r in held)


def test_neighbours_recall_and_ties(spark):
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((1500, 16)).astype(np.float32)
    vectors[100:140] = vectors[100]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2100, [1.0] * 4), (2200, [None] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"h": F.lit(1), "leaf": F.lit("x")})
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, leaf=64).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 1500, 100))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((vectors.astype(float) - vectors[q].astype(float)) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(1500), d)) if i != q][:10]
        hits += len({i for i, _ in found} & set(order))
        assert len(found) == 10 and all(abs(s - d[i]) < 1e-12 for i, s in found)
    assert hits >= 0.95 * 10 * len(got)
    assert [i for i, _ in got[100]] == list(range(101, 111))
    assert neighbours.nearest(df.limit(0)).count() == 0
    few = spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>")
    assert neighbours.nearest(few).count() == 2


def test_neighbours_of_leaves_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows + rows[:60:20], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, k=10, every=20, confidence=0.999999, leaf=32, block=8).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    d = ((vectors[:, None] - vectors[None]) ** 2).sum(axis=2)
    want = {q: [i for i in np.argsort(d[q], kind="stable").tolist() if i != q][:10] for q in range(0, 300, 20)}
    assert dict(got) == want
    monkeypatch.setattr(neighbours, "MOST_LEAVES", 1)  # no leaf is split: all go as blocks
    got.clear()
    for r in neighbours.nearest(df, k=10, every=20, confidence=0.999999, leaf=32, block=8).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert dict(got) == want


def test_neighbours_bring_few_rows_to_the_driver(spark):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((6000, 16)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    own = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in own}
    limit = spark.sparkContext._jsc.sc().conf()
    want = neighbours.nearest(df, every=1000, sample=100).orderBy("query_id", "rank").collect()
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        limit.set("spark.driver.maxResultSize", "400k")  # 100 rows of each of 32 partitions are more
        found = neighbours.nearest(df, every=1000, sample=100)
    finally:
        limit.remove("spark.driver.maxResultSize")
        for k, v in was.items():
            spark.conf.set(k, v)
    assert found.orderBy("query_id", "rank").collect() == want and len(want) == 60


def test_first_points_by_hash_are_those_of_the_whole_order(spark):
    rng = np.random.default_rng(9)
    rows = [(i * 2**50 - 2**62, [float(x)]) for i, x in enumerate(rng.standard_normal(2000))]  # no even hashes: none is in the lowest quarter
    points = spark.createDataFrame(rows, "h long, p array<double>").repartition(7)
    for sample in (1, 10, 300, 1900, 2000, 3000):
        assert neighbours.first_by_hash(points, sample)["p"].tolist() == [p for _, p in rows[:sample]]
    assert len(neighbours.first_by_hash(points.limit(0), 5)) == 0


def test_grafted_tree_places_as_its_parts():
    rng = np.random.default_rng(6)
    points = rng.standard_normal((500, 4))
    nodes = neighbours.kd_tree(points, 100)
    at = neighbours.leaf_of(nodes, points)
    subs = {int(x): neighbours.kd_tree(points[at == x], 9) for x in set(at.tolist()) if x != 1}
    tree, leaves = neighbours.grafted(nodes, len(nodes) + 1, subs)
    now = neighbours.leaf_of(tree, points)
    assert set(now.tolist()) == set(range(leaves)) and (now[at == 1] == 1).all()
    for x, sub in subs.items():
        own = neighbours.leaf_of(sub, points[at == x])
        assert len({(a, b) for a, b in zip(own.tolist(), now[at == x].tolist())}) == len(set(own.tolist()))


def test_sentencepiece_equals_the_library(docs, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    model = sentencepieces.Transducer(path)
    odd = ["", "  a", "a  b   c", " a\n b \n\n c", "日本 語 🙂   ", "aaaaaaaaaaaaaaaaaaaaaaaa", "<0x41> <s>", "llllll", "1234567890 www.example.com"]
    for t in odd + [t for t in corpus(9) if t]:
        ids = np.frombuffer(model.encode(t), "<u4").tolist()
        assert ids == own.encode(t), t
        assert model.decode(ids) == t
    encoded = sentencepieces.encode(docs, path)
    back = {r["doc_id"]: r["text"] for r in sentencepieces.decode(encoded, path).collect()}
    assert all(back[r["doc_id"]] == (r["text"] or "") for r in docs.collect())
    by_id = {r["doc_id"]: own.encode(r["text"] or "") for r in docs.collect()}
    byte = {i for i in range(own.get_piece_size()) if own.is_byte(i)}
    for r in sentencepieces.round_trip(docs, path).collect():
        ids = by_id[r["doc_id"]]
        assert r["decoded_same"] and (r["n_pieces"], r["n_bytes"], r["ids_crc32"]) == (len(ids), sum(i in byte for i in ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert sentencepieces.encode(empty, path).count() == 0


def unigram_model(path, normaliser, rng):
    """A small unigram model with byte fallback, its pieces and scores made up, serialised field by field."""

    def varint(v):
        return bytes([v]) if v < 128 else bytes([v & 127 | 128]) + varint(v >> 7)

    def field(number, v):
        if isinstance(v, bytes):
            return varint(number << 3 | 2) + varint(len(v)) + v
        return varint(number << 3 | 5) + np.float32(v).tobytes() if isinstance(v, float) else varint(number << 3) + varint(v)

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    made = {"▁", *"abcdeé1", *("".join(rng.choice("abcdeé1") for _ in range(rng.randrange(2, 5))) for _ in range(60)), *("▁" + "".join(rng.choice("abcde") for _ in range(rng.randrange(1, 4))) for _ in range(40))}
    pieces += [(p, -float(rng.randrange(200, 1200)) / 100 - 0.001 * i, 1) for i, p in enumerate(sorted(made))]
    data = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    data += field(2, field(3, 1) + field(35, 1)) + field(3, normaliser)
    path.write_bytes(data)
    return str(path)


@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc"])
def test_sentencepiece_unigram_and_normaliser_equal_the_library(tmp_path, rule):
    import sentencepiece

    rng = random.Random(21)
    spec = next(v for n, v in sentencepieces.fields(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()) if n == 3)
    path = unigram_model(tmp_path / "m.model", spec, rng)
    own, model = sentencepiece.SentencePieceProcessor(model_file=path), sentencepieces.Transducer(path)
    texts = ["", " ", "   ", "a", "  a  b ", "ﬁ ab", "①②", "e\u0301 x", "Ａｂ　c", "日本🙂 ab", "a\tb\nc", "½ a…", "\u200bab", "▁a ▁▁b"]
    texts += ["".join(rng.choice("abcdeé1 xﬁ①日\t") for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    for t in texts:
        ids = np.frombuffer(model.encode(t), "<u4").tolist()
        assert ids == own.encode(t), t
        assert model.decode(ids) == model.plain(t)
    assert rule == "identity" or len(model.normal.rules) > 1000


def test_licenses(spark, empty):
    texts = ["Released under the MIT License.", "x y mit\nlicense apache License general public license", None, "", "license", "This work is licensed under the GNU very General Public License, version 3. ok", "Licensed under CC BY-NC 4.0.", "mit licensed"]
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, texts)).collect()}
    assert len(licenses.scan(frame(spark, texts)).collect()) == len(texts) + 2
    assert (got[0]["labels"], got[0]["n_base"], got[0]["first_word"], got[0]["score"]) == ("mit", 1, 3, 1.0)
    assert (got[1]["base_labels"], got[1]["n_base"], got[1]["first_word"], got[1]["last_word"]) == ("apache,gpl,mit", 3, 2, 6)
    assert (got[2]["n_words"], got[2]["labels"], got[2]["first_word"]) == (0, "", None)
    assert got[4]["labels"] == "" and got[7]["labels"] == "" and got[6]["labels"] == "cc-by-nc"
    assert got[5]["labels"] == "gpl" and 0.7 <= got[5]["score"] < 1
    assert licenses.scan(empty).count() == 0


def test_license_wordings_of_close_kin(spark):
    from stationflow.llm.license_texts import TEMPLATES

    want = {t: label for label, t in TEMPLATES} | {"Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa", "Redistribution and use in source and binary forms are permitted": "bsd"}
    texts = list(want)
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, [f"some words first {t} and more" for t in texts])).collect()}
    for i, t in enumerate(texts):
        labels = set(got[i]["labels"].split(",")) - set(got[i]["base_labels"].split(",")) | {want[t]}
        assert want[t] in got[i]["labels"].split(",") and labels == {want[t]} and got[i]["score"] >= 0.9, (t, got[i])


def test_licenses_against_plain_loops(spark):
    """Base columns, and the votes of every diagonal, by loops over words and templates."""
    rng = random.Random(13)
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    parts = ["mit license", "MIT-License", "apache license", "general public\nlicense", "license", "public", "Permission is hereby granted, free of charge,", "Licensed under CC", "BY-NC 4.0.", "any person", "été", "GNU General Public License, version 3.", "This work is licensed under the"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(0, 14))) for _ in range(150)] + [None, ""]
    k, slack, least = 3, 2, 0.7
    kinds = {}
    templates = [(label, [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]) for label, w in ((label, split(t)) for label, t in licenses.TEMPLATES)]
    for label, g in templates:
        for x in g:
            kinds.setdefault(x, set()).add(label)
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, texts)).collect()}
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    for i, t in enumerate(texts):
        w = split(t)
        places = [(a, label) for p, label in phrases.items() for a in range(len(w)) if tuple(w[a : a + len(p)]) == p]
        at = collections.defaultdict(list)
        for a in range(len(w) - k + 1):
            at[tuple(w[a : a + k])].append(a)
        found = []
        for label, g in templates:
            votes = collections.defaultdict(set)
            for pos, x in enumerate(g):
                for a in at.get(x, ()):
                    votes[a - pos].add(pos)
            runs, last = [], None
            for d in sorted(votes):
                if last is None or d - last > slack:
                    runs.append([])
                runs[-1] += [(pos, pos + d) for pos in votes[d]]
                last = d
            own = {p for p, x in enumerate(g) if len(kinds[x]) == 1}
            for run in runs:
                held = {p for p, _ in run}
                if len(held) / len(g) >= least:
                    found.append((min(a for _, a in run), max(a for _, a in run) + k - 1, label, len(held) / len(g), 2 * len(held & own) >= len(own)))
        kept, island, end = [], [], -1
        for f in [*sorted(found), None]:
            if f is None or f[0] > end:
                strong = [x for x in island if x[4]]
                kept += strong or [x for x in island if x[3] == max(y[3] for y in island)]
                island = []
            if f:
                island.append(f)
                end = max(end, f[1])
        labels, best = {x for _, x in places} | {f[2] for f in kept}, max((f[3] for f in kept), default=0.0)
        r, base = got[i], sorted({x for _, x in places})
        assert (r["n_words"], r["n_base"], r["base_labels"], r["labels"]) == (len(w), len(places), ",".join(base), ",".join(sorted(labels))), t
        assert (r["first_word"], r["last_word"]) == ((min(a for a, _ in places), max(a for a, _ in places)) if places else (None, None)) and abs(r["score"] - best) < 1e-12


def test_language_of_many_repeated_rows(spark):
    """One German row repeated many times is one example; no language is lost, none takes all."""
    rng = random.Random(7)
    words = {"en": ["the", "house", "with", "which", "water", "thought"], "fr": ["les", "maison", "avec", "quelle", "eau", "pensée"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(25)), lang) for i, lang in enumerate(["en", "fr"] * 100)]
    few = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    many = spark.range(20_000).select(F.lit(999).cast("long").alias("doc_id"), F.lit("der Hund und die Katze sitzen über dem Brunnen").alias("text"), F.lit("de").alias("lang"))
    docs = few.unionByName(many)
    model = langid.fit(docs, F.lit(True), sample=300)
    assert model.languages == ["de", "en", "fr"]
    got = langid.predict(few, model, keep=("doc_id", "lang")).collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)
    assert langid.predict(many.limit(1), model).first()["lang_pred"] == "de"


def test_stages_take_clashing_names(spark):
    import corpus_pipeline

    names = ["m", "__p", "__b", "__x", "__k", "__t", "__l", "__r", "__same", "rows", "own_0", "__own_0", "bad", "h", "g", "root", "node", "spans"]
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"first {passage} text {i} with its own words" if i % 2 else f"a{i} b{i} plain words here {i} and there" for i in range(8)] + [None]
    rows = [(i, t, "en", "s", len(t or ""), *[i] * len(names)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` long" for c in names))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)], "doc_id long, quality int, toxic int")
    for stage in (lambda d: quality.keep_good(d, labels), lambda d: simhash.deduplicate(d), lambda d: corpus_pipeline.recount(substring.remove(d, window=50)), lambda d: pii.redact(d)):
        got = stage(docs)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes
        assert all(r["doc_id"] == r["m"] == r["spans"] for r in got.collect())
    assert packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).count() >= len(rows)
    cut = {r["doc_id"]: r["text"] for r in substring.remove(docs, window=50).collect()}
    assert cut[1].split() == "1 with its own words".split() and cut[0] == texts[0] and cut[8] is None


def test_lm_words_within_classes_by_history(spark):
    """With `within`, every score follows from the trained numbers by loops, words of a class add up to one after any history, and the history helps to choose them."""
    rng = random.Random(11)
    texts = [" ".join(f"{c}{k}z" for k in (rng.randrange(12) for _ in range(25)) for c in "pq") for _ in range(150)] + [None, "Unseen p1z WORDS"]
    docs = frame(spark, texts).withColumn("held_out", langid.held_out(F.col("doc_id"), 1))
    training = docs.where("not held_out").select(F.col("text").alias("__x"))
    shared, rest = lm.learn_head(training, 20, 10)
    words, tail = shared.value, {r["h"]: r["c"] for r in rest.collect()}
    splits = lm.Splits(words)
    w = lm.train(training, shared, lm.LEAST_BUCKETS, splits=splits)
    table, bits = w.within.table, len(w.within.table).bit_length() - 1
    assert len(table) == lm.SPLIT_BUCKETS * lm.LEAST_BUCKETS and np.abs(table).max() > 0.5

    def log_inside(leaf, contexts):
        up, total = int(splits.up[leaf]), 0.0
        while up >= 0:
            node, side = up >> 1, up & 1
            on = [((int(contexts[k]) >> 32) + node * 0x9E3779B1) % 2**32 >> 32 - bits for k in lm.SEEN]
            z = float(splits.base[node]) + sum(float(table[b]) for b in on)
            total -= math.log1p(math.exp(-z if side else z))
            up = int(splits.up[splits.leaves + node])
        return total

    place = {int(h): i for i, h in enumerate(words.h)}
    apart = lm.score(docs, ~F.col("held_out"), head=20, core=10, keep=("held_out",)).collect()
    rows = {r["doc_id"]: r for r in lm.score(docs, ~F.col("held_out"), head=20, core=10, keep=("held_out",), within=True).collect()}
    for n, r in enumerate(rows.values()):
        data = ("no id here" if r["doc_id"] is None else texts[r["doc_id"]] or "").encode()
        h, e, first = lm.tokens(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        at = words.look(h)
        cls = words.classes(at, e)
        contexts = lm.histories(words.symbols(at, cls), first, words.start)
        total = float(w.log_of(lm.features(contexts, lm.LEAST_BUCKETS), cls).sum())
        for i, x in enumerate(h.tolist()):
            k = int(cls[i])
            total += log_inside(place.get(x, len(place) + k), contexts[:, i])
            if x not in place:
                total += math.log((tail.get(x, 0) + 0.5) / splits.tail[k])
            if n < 3:
                members = [*np.flatnonzero(words.cls == k), len(place) + k]
                assert abs(sum(math.exp(log_inside(m, contexts[:, i])) for m in members) - 1) < 1e-6
        assert abs(total / math.log(10) - r["score"]) < 1e-3
    better = [rows[r["doc_id"]]["score"] - r["score"] for r in apart if r["held_out"]]
    assert sum(better) > 0


def test_lm_pulls_walk_recurring_pairs_once(monkeypatch):
    """The pulls of pairs of a word and one before equal plain loops over all tokens, but each distinct pair is walked once; expected counts equal loops over a softmax."""
    rng = np.random.default_rng(4)
    n, known = 60, 40
    head = lm.Head(rng.integers(-(1 << 62), 1 << 62, known), np.sort(rng.integers(1, 500, known))[::-1].copy(), rng.integers(0, lm.SPELLINGS, known), 9000, known, known)
    head.classify(rng.integers(0, 3, known), [(5, 7, 3)])
    splits, shift = lm.Splits(head), np.uint32(32 - 8)
    pairs = np.stack([rng.integers(0, splits.leaves, n), rng.integers(0, 1 << 32, n)])[:, rng.integers(0, n, 5000)]
    expected, deep = np.zeros(2 << 8), 0
    for leaf, word in pairs.T.tolist():
        up = int(splits.up[leaf])
        while up >= 0:
            node, side = up >> 1, up & 1
            z = float(splits.base[node])
            expected[2 * ((word + node * 0x9E3779B1) % 2**32 >> 24) + side] += 1 / (1 + math.exp(z if side else -z))
            up = int(splits.up[splits.leaves + node])
            deep += 1
    walked, bucket = [], lm.bucket
    monkeypatch.setattr(lm, "bucket", lambda words, up, shift: walked.append(len(up)) or bucket(words, up, shift))
    got = np.zeros(2 << 8)
    splits.pulls(splits.place[pairs[0]].astype(np.uint64) << np.uint64(32) | pairs[1].astype(np.uint64), shift, got)
    assert np.allclose(got, expected, rtol=1e-6) and expected.sum() > 100
    assert sum(walked) == int(splits.depth[np.unique(pairs, axis=1)[0]].sum()) < deep / 20

    w = lm.Weights(np.log(head.mass).astype(np.float32), rng.normal(0, 0.5, (64, lm.CLASSES)).astype(np.float32))
    on, out = rng.integers(0, 64, (lm.BATCH + 7, lm.KINDS)), np.zeros((lm.CLASSES // 2, 64), np.complex64)
    lm.met(on, w.softmax, out)
    p = np.exp(w.bias + w.table[on].astype(np.float64).sum(axis=1))
    p /= p.sum(axis=1, keepdims=True)
    plain = np.zeros((64, lm.CLASSES))
    for k in range(lm.KINDS):
        np.add.at(plain, on[:, k], p)
    assert np.allclose(np.stack([out.real, out.imag], axis=1).reshape(lm.CLASSES, 64).T, plain, rtol=1e-4, atol=1e-4)
    assert np.allclose(w.log_of(on, on[:, 0] % lm.CLASSES), np.log(p[np.arange(len(on)), on[:, 0] % lm.CLASSES]), atol=1e-4)
