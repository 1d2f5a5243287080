"""Text search over an inverted index: segments of postings and norms, all Parquet in one folder.

Each task turns its documents into segments of its own, terms in order with their documents, so building shuffles no
posting and a common term's documents stay spread over all segments. A question reads the postings of its own terms only,
by the files' statistics on the sorted terms, and the norms of the documents found there.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.operators.joins import small
from gneiss.session import bounded_batches, settle, workspace

TOKEN = re.compile(r"[a-z0-9][a-z0-9\-]+")
_IN_TOKEN = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz0123456789-"))
#: Tokens of a segment; it bounds a task's memory.
SEGMENT_TOKENS = 2_000_000
#: Terms of more than one document that may be broadcast while norms are made.
BROADCAST_TERMS = 1_000_000


def terms_of(lowered: str) -> Counter:
    """How often a text holds each token and each pair of neighbouring tokens."""
    tokens = TOKEN.findall(lowered)
    return Counter(tokens) + Counter(f"{a} {b}" for a, b in zip(tokens, tokens[1:], strict=False))


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All tokens of lower-cased texts and how many each text has, as TOKEN finds them, by the kinds of bytes.

    A run of letters, digits and hyphens holds one token: all from its first letter or digit on, if that is two at least.
    """
    texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    inside, cut = np.append(_IN_TOKEN[raw], False), np.zeros(len(raw) + 1, bool)
    cut[bounds] = True
    before = np.concatenate([[False], inside[:-1]])
    starts, ends = np.flatnonzero(inside & (cut | ~before)), np.flatnonzero(before & (cut | ~inside))
    dashed = np.flatnonzero(raw[starts] == ord("-"))
    if len(dashed):
        plain = np.append(np.flatnonzero(inside[:-1] & (raw != ord("-"))), len(raw))
        starts[dashed] = np.minimum(plain[np.searchsorted(plain, starts[dashed])], ends[dashed])
    keep = ends - starts >= 2
    starts, sizes = starts[keep], (ends - starts)[keep]
    to = np.concatenate([[0], np.cumsum(sizes)])
    letters = raw[np.arange(to[-1]) + np.repeat(starts - to[:-1], sizes)]
    tokens = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(to.astype(np.int32)), pa.py_buffer(letters))
    return tokens, np.diff(np.searchsorted(starts, bounds))


def _postings(known: pa.Array, tokens: np.ndarray, docs: np.ndarray, keys: pa.Array) -> Iterator[pa.RecordBatch]:
    """A segment's rows (term, n, keys, counts) in the order of terms, n being how many keys; tokens are numbers of known words, docs of keys.

    A pair of neighbours is one number of two words' ranks. Since the space between them comes before all characters of
    tokens, the order of these numbers is that of the terms, so all counting and sorting is done on numbers.
    """
    place = pc.sort_indices(known)
    known, rank = known.take(place), np.empty(len(known), np.int64)
    rank[place.to_numpy()] = np.arange(len(known))
    tokens = rank[tokens]
    pairs = np.flatnonzero(docs[1:] == docs[:-1])
    codes = np.concatenate([tokens << 32, (tokens[pairs] << 32) + tokens[pairs + 1] + 1])
    owner = np.concatenate([docs, docs[pairs]])
    order = np.argsort(codes, kind="stable")  # documents ascend in both halves, and so within a term
    codes, owner = codes[order], owner[order]
    new = np.concatenate([[True], codes[1:] != codes[:-1]])
    first = np.flatnonzero(new | np.concatenate([[True], owner[1:] != owner[:-1]]))
    counts, owner, begin = np.diff(np.append(first, len(codes))), owner[first], np.flatnonzero(new[first])
    kinds, ends = codes[first][begin], np.append(begin, len(first))
    for lo in range(0, len(kinds), 1 << 15):
        hi = min(lo + (1 << 15), len(kinds))
        one, two = kinds[lo:hi] >> 32, (kinds[lo:hi] & 0xFFFFFFFF) - 1
        terms = pc.binary_join_element_wise(known.take(pa.array(one)), known.take(pa.array(two, mask=two < 0)), " ", null_handling="skip")
        part, bounds = slice(ends[lo], ends[hi]), pa.array(ends[lo : hi + 1] - ends[lo], pa.int32())
        lists = [pa.ListArray.from_arrays(bounds, c) for c in (keys.take(pa.array(owner[part])), pa.array(counts[part], pa.int32()))]
        yield pa.RecordBatch.from_arrays([terms, pa.array(np.diff(ends[lo : hi + 1]), pa.int32()), *lists], names=["term", "n", "keys", "counts"])


def _segments(rows: DataFrame, segment_tokens: int) -> DataFrame:
    """(term, n, keys, counts): per segment a row for each term, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[pa.Array, pa.Array, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            keys, tokens, lengths = zip(*parts, strict=True)
            coded, lengths = pa.concat_arrays(tokens).dictionary_encode(), np.concatenate(lengths)
            yield from _postings(coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(lengths)), lengths), pa.concat_arrays(keys))

        for b in batches:
            parts.append((b.column(0), *_tokens(b.column(1))))
            if sum(len(tokens) for _, tokens, _ in parts) >= segment_tokens:
                yield from flush()
                parts.clear()
        if any(len(tokens) for _, tokens, _ in parts):
            yield from flush()

    return rows.mapInArrow(run, f"term string, n int, keys array<{dict(rows.dtypes)['key']}>, counts array<int>")


def build_index(df: DataFrame, key: str, text: str, folder: str, segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Writes postings (term, n, keys, counts) and norms (key, norm) of a text column under a folder.

    A term's weight in a document is (ln(count) + 1) * idf with idf = ln((1 + n) / (1 + df)) + 1. A null text has no
    terms but counts as a document; keys must be unique.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    rows = df.select(F.col(key).alias("key"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    tasks = spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < tasks:  # a small file is one split
        rows = rows.repartition(tasks)
    _segments(rows, segment_tokens).write.parquet(f"{folder}/postings")
    postings = spark.read.parquet(f"{folder}/postings")
    df.agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{folder}/documents")
    n = spark.read.parquet(f"{folder}/documents").first()["n"]
    several = settle(postings.select("term", "n").groupBy("term").agg(F.sum("n").alias("df")).where("df > 1"))  # the others, most of them, share one idf
    idf = F.log((1 + F.lit(n)) / (1 + F.coalesce("df", F.lit(1)))) + 1
    weights = postings.join(small(several, BROADCAST_TERMS), "term", "left").select(idf.alias("idf"), "keys", "counts")
    each = weights.select("idf", "counts", F.posexplode("keys").alias("i", "keys")).select("keys", ((F.log(F.col("counts")[F.col("i")]) + 1) * F.col("idf")).alias("w"))
    each.groupBy(F.col("keys").alias("key")).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm")).write.parquet(f"{folder}/norms")


def search(spark: SparkSession, folder: str, question: str, k: int = 8) -> DataFrame:
    """(key, similarity) of the k documents most alike to a question: cosine of the weights, ties to the smaller key.

    Similarities are rounded to ten digits, so equal texts tie whatever the order of their sums. Terms that no document
    has are left out of the question; without any other there is no row.
    """
    counts = terms_of(question.lower())
    wanted = sorted(counts)
    n = spark.read.parquet(f"{folder}/documents").first()["n"]
    known = spark.read.parquet(f"{folder}/postings").where(F.col("term").isin(wanted)).groupBy("term").agg(F.sum("n").alias("df"))
    df = {r["term"]: r["df"] for r in known.collect()}
    idf = {t: float(np.log((1 + n) / (1 + d)) + 1) for t, d in df.items()}
    weight = {t: float(np.log(counts[t]) + 1) * idf[t] for t in idf}
    length = float(np.sqrt(sum(w * w for w in weight.values())))
    asked = spark.createDataFrame([(t, idf[t], weight[t]) for t in sorted(idf)], "term string, idf double, weight double")
    postings = spark.read.parquet(f"{folder}/postings").where(F.col("term").isin(sorted(idf))).join(F.broadcast(asked), "term")
    each = postings.select("idf", "weight", F.explode(F.arrays_zip("keys", "counts")).alias("p"))
    dots = each.groupBy(F.col("p.keys").alias("key")).agg(F.sum((F.log("p.counts") + 1) * F.col("idf") * F.col("weight")).alias("dot"))
    found = dots.join(spark.read.parquet(f"{folder}/norms"), "key")
    return found.select("key", F.round(F.col("dot") / (F.col("norm") * length), 10).alias("similarity")).orderBy(F.desc("similarity"), "key").limit(k)


def tfidf_search(df: DataFrame, key: str, text: str, question: str, k: int = 8) -> DataFrame:
    """An index of df in the shared folder and one question to it: (key, similarity)."""
    folder = workspace(df.sparkSession, "index")
    build_index(df, key, text, folder)
    return search(df.sparkSession, folder, question, k).withColumnRenamed("key", key)
