"""Empty tables, null and repeated ids through every stage and the pipeline; a plain lasso; files cut by documents."""

import importlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gneiss.llm import langid, packing, quality, sentencepiece_sa, simhash, token_counts, tokenstore
from gneiss.llm.common import shared_dir


def label_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def odd(spark):
    """Two languages, good and bad texts, copies, null and repeated ids, empty texts, columns that clash."""
    words = {"en": "the of and that was with for this have from", "fr": "le la les des dans une que est avec pour"}
    rng = np.random.default_rng(5)
    rows = []
    for i in range(160):
        lang = ("en", "fr")[i % 2]
        own = words[lang].split() + [f"{lang}{i}x{k}" for k in range(30)]
        text = " ".join(rng.choice(own, 90)) if i % 4 < 3 else "$$ ## " * 40 + f"{i}"
        rows.append((i, text, lang, "s", len(text), "a", 0.5, 1, True))
    rows += [rows[4], rows[4], (4, rows[8][1], "en", "s", 1, "b", 0.1, 2, False), (None, rows[12][1], None, None, None, "c", None, None, None), (None, rows[16][1], "en", "s", 1, "d", 0.2, 3, True)]
    rows += [(500, None, "en", "s", 0, "e", 0.3, 4, True), (501, "", "en", "s", 0, "f", 0.3, 4, True), (502, " ", None, "s", 0, "g", 0.3, 4, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, score double, _id long, _none boolean")
    labels = label_rows(spark, [(i, int(i % 4 < 3), 0) for i in range(160)] + [(None, 1, 0), (3, None, 0), (5, 1, 0), (5, 1, 1)])
    return docs, labels


def test_stages_on_odd_tables(spark, odd):
    docs, labels = odd
    for stage in (lambda d: quality.keep_good(d, labels), langid.keep_known, simhash.keep_one):
        kept = stage(docs)
        rows = kept.collect()
        assert kept.columns == docs.columns and 0 < len(rows) <= docs.count()
        held = {tuple(r) for r in docs.collect()}
        assert all(tuple(r) in held for r in rows)
    pieces = packing.pack_documents(docs)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_stages_on_empty_tables(spark, no_docs):
    none = label_rows(spark, [])
    assert sentencepiece_sa.encode_texts(no_docs).count() == 0 and token_counts.count_tokens(no_docs).count() == 0
    assert quality.classify(no_docs, none).count() == 0
    for kept in (quality.keep_good(no_docs, none), langid.keep_known(no_docs), simhash.keep_one(no_docs)):
        assert kept.count() == 0 and kept.columns == no_docs.columns
    assert packing.pack_documents(no_docs).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_odd_tables(spark, odd, tmp_path, empty):
    pipeline = importlib.import_module("corpus_pipeline")
    docs, labels = odd
    (docs.where("false") if empty else docs).write.parquet(f"{tmp_path}/documents.parquet")
    (labels.where("false") if empty else labels).write.parquet(f"{tmp_path}/labels.parquet")
    found = pipeline.run(spark, str(tmp_path))
    rows = found.collect()
    assert bool(rows) != empty
    after = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        after = stage(spark, after, str(tmp_path))
    assert sum(r["start"] == 0 for r in rows) == after.count()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in after.select("doc_id").collect()}
    if not empty:
        texts = {t for (t,) in after.select("text").collect()}
        assert not any(t and "$$" in t for t in texts) and None not in texts and "" not in texts


def test_repeated_ids_teach_one_text(spark, odd):
    docs, labels = odd
    assert quality.train(docs, labels) == quality.train(docs.repartition(7, "id"), labels)


def test_lasso_against_plain_coordinate_steps():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(quality.STATISTICS)))
    y = (x[:, 0] + 0.5 * x[:, 1] * (x[:, 2] > 0) + rng.normal(scale=0.5, size=400) > 0).astype(float)
    model = quality.fit(x, y, trees=6, penalty=5e-3, rounds=4000)
    a = np.column_stack([r.holds(x) for r in model.rules]).astype(float)
    w, b, n = np.zeros(a.shape[1]), 0.0, len(y)
    for _ in range(3000):  # one weight at a time, by the curvature's bound
        for j in range(a.shape[1]):
            g = a[:, j] @ (1 / (1 + np.exp(-(a @ w + b))) - y) / n
            h = (a[:, j] ** 2).sum() / n / 4
            z = w[j] - g / h
            w[j] = np.sign(z) * max(abs(z) - 5e-3 / h, 0)
        b -= 4 * (1 / (1 + np.exp(-(a @ w + b))) - y).mean()
    loss = lambda w, b: np.log1p(np.exp(-(2 * y - 1) * (a @ w + b))).mean() + 5e-3 * np.abs(w).sum()
    assert abs(loss(np.array(model.weights), model.intercept) - loss(w, b)) < 1e-4
    g = a.T @ (1 / (1 + np.exp(-(a @ np.array(model.weights) + model.intercept))) - y) / n
    assert np.abs(g + 5e-3 * np.sign(model.weights)).max() < 1e-3  # where no weight can be bettered


def test_files_are_cut_by_documents(spark, monkeypatch):
    monkeypatch.setattr(tokenstore, "FILE_DOCUMENTS", 10)
    docs = spark.range(35).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text")).coalesce(1)
    folder = f"{shared_dir(spark)}/cut-files"
    manifest = tokenstore.write_tokens(docs, folder)
    assert max(r["n_docs"] for r in manifest.collect()) <= 10
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in tokenstore.read_tokens(manifest, folder).orderBy("doc_id").collect()] == [(i, i, 1) for i in range(35)]


def test_other_models_are_refused(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "get_score", lambda self, i: -0.5 - i)
    with pytest.raises(ValueError, match="byte-pair"):
        sentencepiece_sa.Codec(sentencepiece_sa.default_path())


def test_recall_of_a_large_shard(spark):
    """One graph over the tables' largest set of vectors, nearly a full shard: recall of ten against brute force."""
    import os

    from gneiss.llm import ann

    path = "/root/testdata/check_l/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("no large table here")
    rows = spark.read.parquet(path).select("vec_id", "embedding")
    v = np.array(rows.orderBy("vec_id").select("embedding").toArrow().column(0).combine_chunks().flatten(), dtype=np.float64).reshape(-1, 64)
    found: dict[int, list[int]] = {}
    for r in ann.nearest(rows, query_modulus=400).collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    hits = []
    for q, got in found.items():
        far = ((v - v[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hits.append(len(set(got) & set(np.argsort(far, kind="stable")[:10].tolist())) / 10)
    assert len(found) == -(-len(v) // 400) and np.mean(hits) >= 0.9
