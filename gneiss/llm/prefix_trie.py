"""Prefix trie of conversations by distributed MSD radix partitioning and multikey quicksort.

Turns are dictionary-encoded, a conversation becomes an array of turn ids, and equal conversations become one row before
anything is dealt out. A bucket holds the sequences below one trie node. A bucket that is too large for a task is asked
for its longest common prefix, by its least and greatest sequence, and dealt by the id that follows; so a round ends a
branching, never a single shared turn. What is small enough is finished where it was shuffled to: multikey quicksort
splits the sequences three ways at one turn after another, and every middle part is a node. The few large buckets'
own nodes get their sums from the nodes below, round by round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.llm.common import bounded_batches, settle

#: A bucket of at most so many sequences and turns is finished in one task.
LOCAL_ROWS, LOCAL_TURNS = 2_000, 200_000
#: The buckets opened in one round are broadcast up to so many prefix turns.
MAX_BROADCAST = 2_000_000
#: The rebuilding of ``shared_heads``: conversations in a group, and most turns that they share less one.
GROUP, MOST_SHARED = 5, 9
EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def sequences(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, seq array<struct<id, bytes>>): the turns of each conversation in order, as dictionary ids with the UTF-8
    bytes of their texts.

    A null role or text is empty; turns come in ascending order, null first, ties by role and text. Rows without a
    conv_id belong to none. The dictionary tells turns apart by the SHA-256 of role and text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    key = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    rows = rows.where("conv_id is not null").withColumn("place", F.row_number().over(order))
    turns = settle(rows.select("conv_id", "place", key.alias("key"), F.octet_length("text").cast("long").alias("bytes")))
    codes = settle(turns.select("key").distinct().withColumn("id", F.monotonically_increasing_id()))
    coded = turns.join(codes, "key").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "id", "bytes"))).alias("seq"))
    return coded.select("conv_id", F.transform("seq", lambda x: F.struct(x["id"].alias("id"), x["bytes"].alias("bytes"))).alias("seq"))


def shared_heads(seqs: DataFrame, group: int = GROUP, most: int = MOST_SHARED) -> DataFrame:
    """Every conversation with its first turns taken from its group's first one.

    With h the unsigned crc32 of the decimal id modulo ``most``: the first h turns of the conversation whose id is less by
    the id's remainder (all if it has fewer, none if it is absent), then the own turns after the first h.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    seqs = settle(seqs)
    heads = seqs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("seq", 1, most - 1).alias("head"))
    rows = seqs.select("conv_id", "seq", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h")).join(heads, "base", "left")
    own = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq") - F.col("h"), F.lit(0)))
    head = F.when(F.col("head").isNull(), F.slice("seq", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    return rows.select("conv_id", F.concat(head, own).alias("seq"))


def _ends(seqs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(first, ends): for each sequence of several conversations the SHA-256 of their ids, ascending and comma-joined.

    Ids stream through the hash in order, so a sequence of any number of copies needs no memory; being one hash, it is
    one task's work, of eight bytes a copy.
    """
    several = distinct.where("n > 1").select("seq", "first")
    rows = seqs.join(several, "seq").select("first", "conv_id").repartition("first").sortWithinPartitions("first", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, hashlib.sha256()
        for b in batches:
            done = []
            firsts, ids = (c.to_pylist() for c in b.columns)
            for first, own in zip(firsts, ids, strict=True):
                if first != now:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = first, hashlib.sha256(str(own).encode())
                else:
                    state.update(f",{own}".encode())
            yield _batch(done)
        if now is not None:
            yield _batch([(now, state.hexdigest())])

    def _batch(done: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["first", "ends"])

    return rows.mapInArrow(run, "first long, ends string")


def local_nodes(p: int, up: int | None, ids: list[list[int]], sizes: list[list[int]], n: list[int], first: list[int], ends: list[str]) -> list[tuple]:
    """The nodes, the top one first, of distinct sequences that share their first p ids: rows of ``_NODE``.

    Multikey quicksort with a stack of its own: at each depth the sequences are split by a pivot id; the middle part is
    the next node, the outer parts are split again at the same depth.
    """
    conv, depth, parent, members, own, ended = [], [], [], [], [], []
    stack: list[tuple[list[int], int, int, bool]] = [(list(range(len(ids))), p, -1, True)]
    while stack:
        rows, d, above, is_node = stack.pop()
        if is_node:
            at = len(conv)
            conv.append(min(first[r] for r in rows))
            depth.append(d)
            parent.append(above)
            members.append(total := sum(n[r] for r in rows))
            own.append((total - 1) * sizes[rows[0]][d - 1] if d else 0)
            ended.append(next((ends[r] for r in rows if len(ids[r]) == d), EMPTY))
            rows = [r for r in rows if len(ids[r]) > d]
            above = at
        if not rows:
            continue
        here = [ids[r][d] for r in rows]
        pivot = sorted((here[0], here[len(here) // 2], here[-1]))[1]
        stack.append(([r for r, x in zip(rows, here, strict=True) if x == pivot], d + 1, above, True))
        for part in ([r for r, x in zip(rows, here, strict=True) if x < pivot], [r for r, x in zip(rows, here, strict=True) if x > pivot]):
            if part:
                stack.append((part, d, above, False))
    children, leaves = [0] * len(conv), [0] * len(conv)
    for i in range(len(conv) - 1, -1, -1):  # a node comes after its parent
        leaves[i] = leaves[i] or 1
        if (a := parent[i]) >= 0:
            children[a] += 1
            leaves[a] += leaves[i]
            own[a] += own[i]
    return [(conv[i], depth[i], up if a < 0 else conv[a], members[i], children[i], leaves[i], own[i], ended[i]) for i, a in enumerate(parent)]


def _local(rows: DataFrame) -> DataFrame:
    """The nodes of all buckets that are small enough; ``top`` marks each bucket's first."""
    bounded_batches(rows.sparkSession)
    dealt = rows.withColumn("key", F.slice("seq", F.lit(1), F.col("p"))).repartition("key").sortWithinPartitions("p", "key")
    dealt = dealt.select("p", "up", F.transform("seq", lambda x: x["id"]).alias("ids"), F.transform("seq", lambda x: x["bytes"]).alias("sizes"), "n", "first", "ends")
    kinds = [pa.int64()] * 7 + [pa.string(), pa.bool_()]
    names = [*(x.split()[0] for x in _NODE.split(", ")), "top"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and (row[0] != held[0][0] or row[2][: row[0]] != held[0][2][: row[0]]):
                    out += solved(held)
                    held = []
                held.append(row)
            yield batch(out)
        if held:
            yield batch(solved(held))

    def solved(held: list[tuple]) -> list[tuple]:
        found = local_nodes(held[0][0], held[0][1], *(list(c) for c in zip(*(r[2:] for r in held), strict=True)))
        return [(*x, i == 0) for i, x in enumerate(found)]

    def batch(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return dealt.mapInArrow(run, _NODE + ", top boolean")


def _common(a: str, b: str) -> Column:
    """Length of the common prefix of two arrays."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x["id"] == y["id"], F.lit(False)))
    differs = F.array_position(same, False)
    return F.when(differs == 0, F.size(same)).otherwise((differs - 1).cast("int"))


def _held(df: DataFrame, turns: int) -> DataFrame:
    return F.broadcast(df) if turns <= MAX_BROADCAST else df


def _upper(opened: list[tuple[DataFrame, DataFrame]], local: DataFrame) -> list[DataFrame]:
    """The nodes of the opened buckets, from the last round up: a bucket's run of single children and its branching."""
    sums = [F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("below"), F.count(F.lit(1)).alias("kids")]
    at = [F.col("parent_conv_id").alias("first"), (F.col("depth") - 1).cast("int").alias("lcp")]
    tops, out = local.where("top and parent_conv_id is not null"), []
    for buckets, ended in reversed(opened):
        found = buckets.join(tops.groupBy(*at).agg(*sums), ["first", "lcp"]).join(ended, ["first", "lcp"], "left")
        found = found.withColumn("depth", F.explode(F.sequence("p", "lcp")))
        run = F.slice("lo", F.greatest(F.col("depth"), F.lit(1)), F.col("lcp") - F.greatest(F.col("depth"), F.lit(1)) + 1)
        saved = F.aggregate(run, F.lit(0).cast("long"), lambda s, x: s + x["bytes"]) * (F.col("n") - 1)
        last = F.col("depth") == F.col("lcp")
        columns = {
            "conv_id": F.col("first"), "depth": F.col("depth").cast("long"), "parent_conv_id": F.when(F.col("depth") == F.col("p"), F.col("up")).otherwise(F.col("first")),
            "n_convs": F.col("n"), "n_children": F.when(last, F.col("kids")).otherwise(1).cast("long"), "n_leaves": F.col("leaves"), "saved_tokens": F.col("below") + saved,
            "ends_sha256": F.when(last, F.coalesce("ends", F.lit(EMPTY))).otherwise(EMPTY), "top": F.col("depth") == F.col("p"),
        }
        nodes = settle(found.select(*(c.alias(k) for k, c in columns.items())))
        out.append(nodes)
        tops = local.where("top and parent_conv_id is not null").unionByName(nodes.where("top and parent_conv_id is not null"))
    return out


def trie(seqs: DataFrame, local_rows: int = LOCAL_ROWS, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """One row of ``_NODE`` for each distinct prefix of the (conv_id, seq) rows, whose ids are distinct.

    conv_id is a node's smallest member; with the depth it names the node. parent_conv_id is the parent's (null at the
    root). n_leaves counts the childless nodes of the subtree, the top included, saved_tokens adds each node's members
    less one times the bytes of its last text. ends_sha256 is of the ids that end there, ascending and comma-joined.
    Without rows there are no members and no nodes, the root included. A conversation is held whole by a task.
    """
    seqs = settle(seqs)
    distinct = settle(seqs.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first")))
    alone = F.sha2(F.col("first").cast("string"), 256)
    rows = distinct.join(_ends(seqs, distinct), "first", "left").withColumn("ends", F.coalesce("ends", alone))
    rows = settle(rows.select("seq", "n", "first", "ends", F.lit(0).alias("p"), F.lit(None).cast("long").alias("up")))
    small, opened = [], []
    while True:
        keyed = rows.withColumn("key", F.slice("seq", F.lit(1), F.col("p")))
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.sum(F.size("seq")).alias("turns"))
        large = settle(sizes.where((F.col("k") > 1) & ((F.col("k") > local_rows) | (F.col("turns") > local_turns))).select("key"))
        turns = large.agg(F.sum(F.size("key") + 1)).first()[0]
        if not turns:
            small.append(rows)
            break
        least = [F.min("seq").alias("lo"), F.max("seq").alias("hi"), F.sum("n").alias("n"), F.min("first").alias("first"), F.min("up").alias("up")]
        buckets = settle(keyed.join(_held(large, turns), "key").groupBy("key").agg(*least).withColumn("lcp", _common("lo", "hi")).withColumn("p", F.size("key")).drop("hi"))
        dealt = keyed.join(_held(buckets.select("key", "lcp", F.col("first").alias("above")), turns), "key", "left")
        small.append(dealt.where("lcp is null").select(*rows.columns))
        ended = dealt.where(F.size("seq") == F.col("lcp")).select(F.col("above").alias("first"), "lcp", "ends")
        opened.append((buckets.drop("key"), ended))
        rows = settle(dealt.where(F.size("seq") > F.col("lcp")).select("seq", "n", "first", "ends", (F.col("lcp") + 1).alias("p"), F.col("above").alias("up")))
    local = settle(_local(reduce(DataFrame.unionByName, small)))
    return reduce(DataFrame.unionByName, _upper(opened, local), local).drop("top")


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", heads: bool = False, local_rows: int = LOCAL_ROWS, local_turns: int = LOCAL_TURNS) -> DataFrame:
    """The trie of all conversations (see ``sequences`` and ``trie``), with ``heads`` of the ones ``shared_heads`` rebuilds.

    Repeated rows are turns of their own; other columns are ignored; an empty table gives no rows.
    """
    seqs = sequences(conversations, conv_col, turn_col, role_col, text_col)
    return trie(shared_heads(seqs) if heads else seqs, local_rows, local_turns)
