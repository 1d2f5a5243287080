"""What must hold past the sizes of the given tables: many languages, short documents, clashing names, bounded caches."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gneiss.llm import langid, packing, rules, simhash, token_counts


def of_languages(n, each, seed=1, words=160):
    """(doc_id, text, lang) rows of made-up languages with word endings of their own."""
    rng = np.random.default_rng(seed)
    ends = [a + b for a in "bcdfghjklm" for b in "aeiou"]
    out = []
    for x in range(n):
        own = [f"{s}{ends[x % 50]}{'xyz'[x // 50 % 3]}" for s in ("ba", "ko", "mi", "lu", "te", "ran", "sol", "vik", "pem", "dor", "fa", "gu", "hy", "jo", "nu", "wa")]
        out += [(len(out) + k, " ".join(rng.choice(own, words)) + f" {x} {k} end", f"l{x:03d}") for k in range(each)]
    return out


def test_every_language_is_a_reference(spark):
    rows = [r for r in of_languages(70, 4) if r[2] < "l068" or r[0] % 4 < 2]
    found = {r["doc_id"]: r["kept"] for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    kept = Counter(x for i, _, x in rows if found[i])
    assert kept == Counter(x for _, _, x in rows)


def test_references_in_parts_give_the_same(spark, monkeypatch):
    df = spark.createDataFrame(of_languages(5, 4) + [(1000, " ".join(f"odd{i}" for i in range(200)), None), (1001, None, "l001")], "doc_id long, text string, lang string")
    whole = sorted(map(tuple, rules.judge(df).collect()), key=repr)
    monkeypatch.setattr(rules, "REFERENCE_CELLS", 1)
    assert sorted(map(tuple, rules.judge(df).collect()), key=repr) == whole and not all(r[7] for r in whole)


def test_short_documents_fill_their_sequences(spark):
    docs = spark.range(6400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "").otherwise("Of the").alias("text"))
    found = packing.pack_documents(docs).collect()
    tokens = sum(r["length"] for r in found)
    sequences = {r["sequence_id"] for r in found}
    assert tokens >= 0.9 * 1024 * len(sequences) and len(found) == 6400
    ends = Counter()
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 1024


def test_kept_rows_keep_their_own_columns(spark):
    rows = [(1, "a text of its own " * 9, "keep-a", True, 5), (2, "quite another one, really " * 9, "keep-b", False, 6), (2, "quite another one, really " * 9, "keep-b", False, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string, _none boolean, _copy long")
    assert sorted(map(tuple, simhash.keep_one(docs).collect())) == rows[:2]


def test_word_cache_is_bounded_in_letters():
    machine = token_counts.Automaton(["a", "ab"], ["b", "c"])
    words = ["ab", "a" + "b" * 5000, "ab" + "c" * 64]
    assert machine.of(words) == machine.of(words) == [1, 5000, 65]
    assert set(machine.cache) == {"ab"}


def test_every_language_is_learned(spark):
    rows = [r for r in of_languages(70, 12, words=60) if r[2] < "l069" or r[0] % 12 < 6]
    found = langid.detect(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    lang = {i: x for i, _, x in rows}
    assert {r["lang_pred"] for r in found} == set(lang.values())
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in found if r["held_out"]]) > 0.9


def test_feature_rows_shrink_with_the_languages():
    assert [langid.feature_bits(k) for k in (1, 4, 64, 65, 1200, 1 << 23)] == [17, 17, 17, 16, 12, 1]


@pytest.mark.parametrize("chunked", [8, 1])
def test_windows_of_a_long_text_give_the_same(monkeypatch, chunked):
    monkeypatch.setattr(langid, "_CHUNKED", chunked)
    rng = np.random.default_rng(3)
    rows = of_languages(3, 10, words=50)
    model = langid.fit([t for _, t, _ in rows], [x for _, _, x in rows])
    text = [w for i in rng.permutation(len(rows)) for w in langid.words_of(rows[i][1])]
    whole = model.means([text])
    monkeypatch.setattr(langid, "_CELLS", 3 * 170)
    assert np.allclose(model.means([text]), whole)
    together = model.means([text[:40], text[40:45], text[45:50]])
    assert np.allclose(together, [model.means([w])[0] for w in (text[:40], text[40:45], text[45:50])])


def test_a_long_text_is_labelled_in_bounded_memory():
    import tracemalloc

    rows = of_languages(64, 3, words=40)
    model = langid.fit([t for _, t, _ in rows], [x for _, _, x in rows], rounds=3)
    text = " ".join(t for _, t, _ in rows) * 4
    peaks = []
    for n in (1, 4):
        words = langid.words_of(text * n)
        tracemalloc.start()
        model.means([words])
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert len(words) > 100_000 and peaks[1] < 1.2 * peaks[0] < 3e8


def test_groups_of_chains_add_up(monkeypatch):
    rows = of_languages(5, 8, words=30)
    docs = [(langid.words_of(t), int(x[1:])) for _, t, x in rows]
    (whole,) = langid.chain_groups(docs, 5, 4)
    monkeypatch.setattr(langid, "_CELLS", 1)
    parts = langid.chain_groups(docs, 5, 4)
    assert len(parts) == 10
    rng = np.random.default_rng(0)
    values = [rng.normal(size=(1 << 17, 5)), rng.normal(size=(5, 5)), rng.normal(size=5)]
    for i, g in enumerate(whole.gradient(*values)):
        assert np.allclose(g, sum(p.gradient(*values)[i] for p in parts))


def test_the_language_draw_passes_on_little(spark):
    """The rows that leave the tasks are a little more than those taken, however many tasks there are."""
    df = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("wort "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 2 == 0, "aa").otherwise("bb").alias("lang"))
    seen = []
    own = langid._drawn
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(langid, "_drawn", lambda rows, spark, limits, *rest: seen.append(limits) or own(rows, spark, limits, *rest))
        patch.setattr(langid, "fit", lambda texts, langs: Counter(langs))
        assert langid.train(df.repartition(64)) == {"aa": 600, "bb": 600}
    assert len(seen) == 1 and all(limit < -(2**63) + 0.08 * 2**64 for limit in seen[0].values())
