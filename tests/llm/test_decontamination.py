"""Decontamination against plain loops and its SQL twin; removal of documents and spans."""

import glob
import hashlib
import re

import duckdb
import pytest
from llm_data import DATA

from gneiss.llm import decontamination, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_report(docs, items, n=10):
    known = {}
    for item, text in items:
        w = plain_words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            known.setdefault(tuple(w[i : i + size]), set()).update(() if item is None else {str(item)})
    out = []
    for doc, text in docs:
        w, hit, ids = plain_words(text), set(), set()
        for size in {len(k) for k in known}:
            for i in range(len(w) - size + 1):
                if (k := tuple(w[i : i + size])) in known:
                    hit.update(range(i, i + size))
                    ids |= known[k]
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def same_rows(df, expected):
    return sorted(map(tuple, df.collect()), key=repr) == expected


ITEMS = [
    (1, "One two THREE four five six seven eight nine ten eleven twelve"),
    (2, "short item, of five words"),
    (2, "Été naïve"),
    (10, "three-four five six seven eight nine ten eleven twelve!"),
    (None, "nobody knows this item"),
    (5, None),
    (6, " ,. "),
    (7, "five words"),
]


@pytest.fixture(scope="module")
def planted(spark):
    rows = [
        (1, "before one two three four five six seven eight nine ten eleven twelve after"),
        (1, "before one two three four five six seven eight nine ten eleven twelve after"),
        (2, "One, two; three/four\tfive six\nseven eight nine ... TEN and more"),
        (3, "one two three four five six seven eight nine"),
        (4, None),
        (5, ""),
        (None, "a short item of five words, and Été naïve; été naïve too"),
        (6, "nobody knows this item"),
        (7, "x" * 100_000 + " " + "five words " * 30_000),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_report_against_loops(spark, planted):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontamination.report(planted, items)
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert same_rows(found, plain_report([tuple(r) for r in planted.collect()], ITEMS))


def test_report_without_broadcast_and_with_a_full_bit_table(spark, planted, monkeypatch):
    monkeypatch.setattr(decontamination, "MAX_BROADCAST", 0)
    monkeypatch.setattr(decontamination, "MAX_LONGS", 1)
    monkeypatch.setattr(decontamination, "BITS_PER_WINDOW", 1)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert same_rows(decontamination.report(planted, items), plain_report([tuple(r) for r in planted.collect()], ITEMS))


def test_report_on_the_tables_against_loops(spark):
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    expected = plain_report([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert any(r[-1] for r in expected)
    assert same_rows(decontamination.report(docs, items), expected)


@pytest.mark.parametrize("name", ["op11_decontamination", "op12_conversation_trie", "op13_hard_negatives"])
def test_sql_twins(spark, name):
    db = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        db.execute(f"create view {p.split('/')[-1][:-8]} as select * from read_parquet('{p}')")
    df = queries.QUERIES[name](spark, DATA)
    twin = db.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in twin.description]
    assert sorted(names) == sorted(df.columns)
    assert same_rows(df.select(*names), sorted(twin.fetchall(), key=repr))


def test_empty_tables_and_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = items.limit(0)
    assert decontamination.report(no_docs, items).count() == 0
    assert same_rows(decontamination.report(odd_docs, none), plain_report([(r["doc_id"], r["text"]) for r in odd_docs.collect()], []))
    assert same_rows(decontamination.report(odd_docs, items), plain_report([(r["doc_id"], r["text"]) for r in odd_docs.collect()], ITEMS))
    for spans in (False, True):
        assert decontamination.remove(odd_docs, none, spans=spans).columns == odd_docs.columns
        assert sorted(map(repr, decontamination.remove(odd_docs, none, spans=spans).collect())) == sorted(map(repr, odd_docs.collect()))
        assert decontamination.remove(no_docs, items, spans=spans).count() == 0


def test_documents_and_spans_are_removed(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    bad = "It says: Alpha, beta gamma\tdelta epsilon zeta eta theta iota KAPPA. Then\nit goes on."
    rows = [(1, bad, "a", 0), (1, bad, "b", 0), (2, "alpha beta, clean", "c", 1), (None, bad, "d", 2), (3, None, "e", 3), (4, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "f", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string, _1 long")
    left = decontamination.remove(docs, items)
    assert left.columns == docs.columns and sorted(r["hits"] for r in left.collect()) == ["c", "e"]
    cut = {r["hits"]: r["text"] for r in decontamination.remove(docs, items, spans=True).collect()}
    gone = "It says: Then\nit goes on."
    assert cut == {"a": gone, "b": gone, "c": "alpha beta, clean", "d": gone, "e": None, "f": ""}
    half = {r["hits"] for r in decontamination.remove(docs, items, most_hit=0.8).collect()}
    assert half == {"a", "b", "c", "d", "e"}
