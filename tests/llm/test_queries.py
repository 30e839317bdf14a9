"""The registered queries as registered: against their SQL, and where there is none, the columns that their contracts name."""

import hashlib
import re
import zlib
from pathlib import Path

import duckdb
import pytest

from stationflow.llm import pii, queries
from tests.llm.test_llm import fingerprint
from tests.test_oracles import plain

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall())


def rows(spark, name):
    return queries.queries()[name](spark, str(DATA)).collect()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    df = queries.queries()[name](spark, str(DATA))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    relation = con.sql(queries.SQL[name])
    columns = sorted(df.columns)
    at = {c: i for i, c in enumerate(relation.columns)}
    assert sorted(at) == columns
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(plain(r[at[c]]) for c in columns) for r in relation.fetchall())


def test_neighbours(spark):
    got = rows(spark, "op1_projected_neighbours")
    vectors = {i: v for i, v in duckdb.sql(f"SELECT vec_id, embedding FROM '{DATA}/embeddings.parquet'").fetchall() if v and any(v)}
    found = hits = 0
    for q in (i for i in vectors if i % 100 == 0):
        near = sorted((sum((a - b) ** 2 for a, b in zip(vectors[q], v)) ** 0.5, i) for i, v in vectors.items() if i != q)[:10]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r for r, _, _ in own] == list(range(1, len(near) + 1))
        hits += len({i for _, i, _ in own} & {i for _, i in near})
        found += len(near)
    assert hits >= 0.9 * found


def test_scores_and_languages(spark, texts):
    scores = rows(spark, "op2_maxent_scores")
    assert {r["doc_id"]: r["held_out"] for r in scores} == {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts} and all(r["score"] < 0 for r in scores)
    got = {r["doc_id"]: r for r in rows(spark, "op3_output_code_language")}
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{DATA}/documents.parquet'").fetchall())
    assert {i: r["held_out"] for i, r in got.items()} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in texts}
    held = [i for i, r in got.items() if r["held_out"] and lang[i] and re.search(r"[^\W\d_]", texts[i] or "")]
    assert sum(got[i]["lang_pred"] == lang[i] for i in held) >= 0.9 * len(held)
    assert {r["lang_pred"] for r in got.values()} <= {*lang.values(), "und"} and all(0 <= r["score"] <= 1 and r["ambiguous"] in (True, False) for r in got.values())


def test_packing(spark, texts):
    got = rows(spark, "op4_cutting_stock_packing")
    assert {r["doc_id"] for r in got} == set(texts)
    by, by_doc = {}, {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    for parts in [*by.values(), *([p[:2] for p in v] for v in by_doc.values())]:
        ends = [0]
        for at, n in sorted(parts):
            assert at == ends[-1]
            ends.append(at + n)
    assert all(sum(n for _, n, _ in v) == v[0][2] for v in by_doc.values())


def test_fingerprints(spark, texts):
    for r in rows(spark, "op5_simhash_near_dedup"):
        assert r["fingerprint"] == f"{fingerprint(texts[r['doc_id']], 3):016x}" and r["component_id"] <= r["doc_id"]


def test_pieces(spark, texts):
    got = rows(spark, "op7_sentencepiece_transducer")
    assert len(got) == len(texts) and all(r["decoded_same"] for r in got)


def test_quality(spark, texts):
    got = rows(spark, "op8_quality_rules")
    assert len(got) == len(texts) and all(r["kept"] == (not r["base_failed"] and r["rule"] is None) for r in got)


def test_personal_data(spark, texts):
    for r in rows(spark, "op9_semi_markov_pii"):
        base = pii.joined(pii.patterns(texts[r["doc_id"]] or ""))
        spans = [s for s in r["spans"].split(",") if s]
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and {s for s in base.split(",") if s} <= set(spans)
        assert r["n_spans"] == len(spans) and r["n_secret"] == sum(s.startswith("secret:") for s in spans)


def test_licenses(spark, texts):
    for r in rows(spark, "op10_license_diagonals"):
        assert {x for x in r["base_labels"].split(",") if x} <= {x for x in r["labels"].split(",") if x} and 0 <= r["score"] <= 1


def test_pipeline(spark):
    """Every stage runs on what the one before kept; the result is that of the stages one by one."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    n = docs.count()
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, str(DATA))
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns and 0 < docs.count() <= n
            n = docs.count()
            assert {r["doc_id"] for r in docs.select("doc_id").collect()} <= {r["doc_id"] for r in before.select("doc_id").collect()}
    final = sorted(map(str, docs.select("doc_id", "start", "length", "ids_crc32").collect()))
    assert final == sorted(map(str, corpus_pipeline.run(spark, str(DATA)).select("doc_id", "start", "length", "ids_crc32").collect()))


def test_base_scores_train_nothing(spark, monkeypatch):
    """The base columns of op2 are the same with and without a model, and without one no class is looked for and nothing is trained."""
    want = {r["doc_id"]: r for r in rows(spark, "op2_maxent_scores")}
    monkeypatch.setattr(queries.lm, "company", None)
    monkeypatch.setattr(queries.lm, "train", None)
    got = rows(spark, "base_op2_maxent_scores")
    assert len(got) == len(want) and set(got[0].asDict()) == {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"}
    for r in got:
        own = want[r["doc_id"]]
        assert all(r[c] == own[c] for c in ("held_out", "n_tokens", "n_known", "train_tokens")) and abs(r["base_score"] - own["base_score"]) < 1e-5
