"""SimHash near-duplicates: 64-bit fingerprints, BK-trees per shard, connected components.

Two fingerprints within r bits agree on at least m - r of any m parts of their bits. Each choice of m - r parts is a
band; the fingerprints of a band with equal values there form a shard. Each shard gets a BK-tree (children keyed by
their Hamming distance to the parent) and only edges that the triangle inequality leaves open are followed. A shard's
tree is built where its rows are shuffled to. The fingerprints of a shard over ``tree_rows`` are dealt to bands of the
bits that the shard leaves free, by the same rule; only what is over ``tree_rows`` again, fingerprints that agree on some
40 bits or more, is cut into chunks, and every pair of chunks (one gives the tree, the other the queries) is work of its own. So
no task holds an unbounded group, and no fingerprint is copied for every other one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.llm.common import bounded_batches, settle

SEED = 42
RADIUS = 3
SHINGLE_WORDS = 3
#: Most fingerprints in one tree.
TREE_ROWS = 1024
_QUERY_BLOCK = 2048
_BUFFER_ROWS = 50_000
_GROUP = ("band", "inner", "shard", "i", "j")


def fingerprint(data: bytes | None, words_in_shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of a UTF-8 text: a bit is 1 if set in over half of the shingles' XXH64 values; no word gives 0."""
    words = data.lower().split() if data else []
    if not words:
        return 0
    if len(words) <= words_in_shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.array([digest(join(s), SEED) for s in zip(*(words[i:] for i in range(words_in_shingle)), strict=False)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(id, copy, fp long): the fingerprint of each whole text, as a signed long, and a hash of the text that tells rows
    of one id apart. A null text counts as empty."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.fromiter((fingerprint(t, words_in_shingle) for t in b.column(1).cast(pa.binary()).to_pylist()), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(out.view(np.int64))], names=["id", "copy", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), text_hash(text_col).alias("copy"))
    return rows.mapInArrow(run, "id long, copy long, fp long")


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).cast("string"))


def band_masks(parts: int, radius: int = RADIUS) -> list[int]:
    """A 64-bit mask (signed) for each choice of ``parts - radius`` of the parts of the bits."""
    edges = [round(64 * i / parts) for i in range(parts + 1)]
    masks = [sum(((1 << (edges[p + 1] - edges[p])) - 1) << edges[p] for p in chosen) for chosen in combinations(range(parts), parts - radius)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def inner_masks(mask: int, radius: int = RADIUS, parts: int = 2 * RADIUS) -> list[int]:
    """Bands inside a shard of ``mask``: its bits and a choice of ``parts - radius`` of the parts of its free bits."""
    free = [b for b in range(64) if not mask >> b & 1]
    pieces = [sum(1 << b for b in free[len(free) * i // parts : len(free) * (i + 1) // parts]) for i in range(parts)]
    masks = [(mask % (1 << 64)) | sum(chosen) for chosen in combinations(pieces, parts - radius)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def parts_for(count: int, radius: int = RADIUS, shard_rows: int = 64) -> int:
    """The fewest parts for which uniform fingerprints make shards of at most ``shard_rows`` on average. Any is exact."""
    parts = radius + 1
    while parts < 16 and count / 2 ** ((64 // parts) * (parts - radius)) > shard_rows:
        parts += 1
    return parts


def bk_links(fp: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of row numbers within ``radius`` bits in the same group, found through one BK-tree per group.

    fp: uint64, sorted by group; side: 0 tree only, 1 query only, 2 both. All trees of the batch grow and are searched
    level by level, so each level is one set of array operations.
    """
    inside = np.flatnonzero(side != 1)
    if not inside.size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    tree_groups, first = np.unique(group[inside], return_index=True)
    roots = inside[first]
    is_root = np.zeros(len(fp), bool)
    is_root[roots] = True
    active = inside[~is_root[inside]]
    at = roots[np.searchsorted(tree_groups, group[active])]
    kids, keys = [], []
    while active.size:
        key = at * 65 + np.bitwise_count(fp[active] ^ fp[at])
        taken, where, which = np.unique(key, return_index=True, return_inverse=True)
        child = active[where]
        kids.append(child)
        keys.append(taken)
        own = child[which]
        rest = own != active
        at, active = own[rest], active[rest]
    child_key = np.concatenate(keys) if keys else np.empty(0, np.int64)
    order = np.argsort(child_key, kind="stable")
    child_key, child = child_key[order], (np.concatenate(kids) if kids else np.empty(0, np.int64))[order]

    asks = np.flatnonzero(side != 0)
    place = np.searchsorted(tree_groups, group[asks])
    known = (place < len(tree_groups)) & (tree_groups[np.minimum(place, len(tree_groups) - 1)] == group[asks])
    asks, place = asks[known], place[known]
    left, right = [], []
    for lo in range(0, len(asks), _QUERY_BLOCK):
        q, node = asks[lo : lo + _QUERY_BLOCK], roots[place[lo : lo + _QUERY_BLOCK]]
        while q.size:
            d = np.bitwise_count(fp[q] ^ fp[node]).astype(np.int64)
            hit = (d <= radius) & (q != node)
            left.append(q[hit])
            right.append(node[hit])
            begin = np.searchsorted(child_key, node * 65 + np.maximum(d - radius, 0), "left")
            count = np.searchsorted(child_key, node * 65 + np.minimum(d + radius, 64), "right") - begin
            q = np.repeat(q, count)
            node = child[np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(len(q))]
    return np.concatenate(left or [np.empty(0, np.int64)]), np.concatenate(right or [np.empty(0, np.int64)])


def local_roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest row number in each row's connected component."""
    label = np.arange(count)
    while True:
        before = label.copy()
        np.minimum.at(label, left, label[right])
        np.minimum.at(label, right, label[left])
        label = label[label]
        if np.array_equal(before, label):
            return label


def _shard_links(radius: int):
    def solve(t: pa.Table) -> pa.RecordBatch:
        fp = t.column("fp").to_numpy().view(np.uint64)
        group = np.cumsum(np.concatenate([[0], np.any([np.diff(t.column(c).to_numpy()) != 0 for c in _GROUP], axis=0)]))
        left, right = bk_links(fp, group, t.column("side").to_numpy(), radius)
        root = local_roots(len(fp), left, right)
        linked = np.flatnonzero(root != np.arange(len(fp)))
        signed = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[linked]), pa.array(signed[root[linked]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard; whole shards are solved together, the last one waits for its rest."""
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= _BUFFER_ROWS:
                t = pa.Table.from_batches(held).combine_chunks()
                new = np.flatnonzero(np.any([np.diff(t.column(c).to_numpy()) != 0 for c in _GROUP], axis=0))
                if new.size:
                    cut = int(new[-1]) + 1
                    yield solve(t.slice(0, cut).combine_chunks())
                    held = t.slice(cut).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    return run


def links(distinct: DataFrame, count: int, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """(a long, b long): within every shard a star for each of its connected groups of fingerprints.

    Each pair within ``radius`` bits shares a shard or a pair of chunks, so the stars connect exactly what the links
    connect, with at most one row per fingerprint and shard instead of all pairs.
    """
    masks = band_masks(parts_for(count, radius), radius)
    deal = lambda found: F.posexplode(F.transform(found, lambda m: F.col("fp").bitwiseAND(m)))

    def sized(shards: DataFrame) -> DataFrame:
        sizes = shards.groupBy("band", "inner", "shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        return shards.join(sizes, ["band", "inner", "shard"])

    shards = distinct.select("fp", deal(F.lit(masks)).alias("band", "shard")).select("fp", "band", F.lit(-1).alias("inner"), "shard")
    rows = sized(shards)
    over = rows.where(F.col("n") > tree_rows)
    inner = F.get(F.array(*(F.lit(inner_masks(m, radius)) for m in masks)), F.col("band"))
    again = sized(over.select("fp", "band", deal(inner).alias("inner", "shard")))
    again = again.withColumn("chunks", F.ceil(F.col("n") / tree_rows).cast("int"))
    again = again.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    again = again.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    again = again.select("fp", "band", "inner", "shard", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"))
    whole = rows.where(F.col("n") <= tree_rows).select("fp", "band", "inner", "shard", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(2).alias("side"))
    dealt = whole.unionByName(again).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "fp")
    return dealt.mapInArrow(_shard_links(radius), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, by alternating large-star and small-star rounds.

    Every round is a partially aggregated minimum and one join; large hubs are split by the adaptive skew join.
    """
    now = settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        to_low, down = F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.join(low, "u").select(F.explode(F.array(to_low, down)).alias("e"))
        after = settle(small.select("e.*").where("u <> v").distinct())
        same = after.count() == now.count() and after.join(now, ["u", "v"], "left_anti").isEmpty()
        now = after
        if same:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def classes(own: DataFrame, first: Column, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """(fp, first): the minimum ``first`` of the rows (id, copy, fp) of each fingerprint's connected component."""
    distinct = settle(own.groupBy("fp").agg(F.min(first).alias("least")))
    linked = components(links(distinct, distinct.count(), radius, tree_rows))
    linked = linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct())
    member = distinct.join(linked, distinct.fp == linked.node).select("fp", "root", "least")
    least = member.groupBy("root").agg(F.min("least").alias("found"))
    moved = member.join(least, "root").select("fp", "found")
    return distinct.join(moved, "fp", "left").select("fp", F.coalesce("found", "least").alias("first"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, words_in_shingle: int = SHINGLE_WORDS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """(id_col, fingerprint, component_id) for every row of docs.

    Fingerprints of at most ``radius`` differing bits link; component_id is the smallest id reachable, the row's own
    included. A null or wordless text has fingerprint zero and links like any other. Repeated rows each give a row. A
    null id takes part and gets the smallest non-null id of its component, or null if there is none. Other columns of
    docs are ignored; an empty table gives no rows.
    """
    own = settle(fingerprints(docs, id_col, text_col, words_in_shingle).drop("copy"))
    # Settled, so that the last join stands right on its two exchanges and a fingerprint of many copies can be split.
    found = settle(classes(own, F.col("id"), radius, tree_rows).withColumnRenamed("first", "component_id"))
    out = own.join(found, "fp")
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, words_in_shingle: int = SHINGLE_WORDS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """One row of docs for each component: that of its smallest id, a null one last, and of that id's rows in the
    component the text of the smallest hash. Columns as in docs.

    Rows of equal id and text are in one component, so the two name a component's row; rows that share an id, or have
    none, are kept apart wherever their components differ.
    """
    own = settle(fingerprints(docs, id_col, text_col, words_in_shingle))
    keys = ["_none", "_id", "_copy"]
    row = F.struct(F.col("id").isNull().alias("_none"), F.coalesce("id", F.lit(0)).alias("_id"), F.col("copy").alias("_copy"))
    kept = settle(classes(own, row, radius, tree_rows).select("first.*").distinct())
    names = [f"c{i}" for i in range(len(docs.columns))]  # free of clashes with the keys
    id_, text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    number = F.col(id_).cast("long")
    rows = docs.toDF(*names).withColumns({"_none": number.isNull(), "_id": F.coalesce(number, F.lit(0)), "_copy": text_hash(text)})
    one = rows.join(kept, keys, "left_semi").dropDuplicates(keys)
    return one.select(*(F.col(a).alias(b) for a, b in zip(names, docs.columns, strict=True)))
