"""The conversation trie against plain loops over all prefixes."""

import hashlib
import zlib

import pytest
from llm_data import DATA

from gneiss.llm import prefix_trie


def plain_conversations(rows):
    """rows: (conv_id, turn, role, text) -> the rebuilt turns of each conversation."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return own, out


def plain_trie(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {p: [q for q in nodes if len(q) == len(p) + 1 and q[: len(p)] == p] for p in nodes}
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in kids[p]) or 1
        saved[p] = sum(saved[q] for q in kids[p]) + (len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(p))
        parent = min(nodes[p[:-1]]) if p else None
        out.append((min(members), len(p), parent, len(members), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


ODD = (
    [(c, t, "user" if t % 2 else "bot", f"turn {t} {'é' * (c % 2) if t > 3 else ''}") for c in range(-12, 30) for t in range(c % 7 + 1)]
    + [(100, None, None, None), (100, 1, "a", "b"), (100, 1, "a", "b"), (100, 1, None, "b"), (100, 0, "x", ""), (None, 0, "a", "b"), (101, 3, "", "")]
    + [(1000 + i, t, "u", "same") for i in range(40) for t in range(12)]
    + [(2000 + i, t, "u", "same" if t < 10 else f"own {i % 9}") for i in range(40) for t in range(12)]
    + [(3000, t, "u", "long " * 1000) for t in range(300)]
    + [(4000, 0, "ab", "c"), (4001, 0, "a", "bc")]
)
KINDS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize(("rows", "turns"), [(2_000, 200_000), (3, 200_000), (1, 1)])
@pytest.mark.parametrize("heads", [False, True])
def test_against_loops(spark, rows, turns, heads):
    df = spark.createDataFrame([(*r, 1.5, "x") for r in ODD], KINDS + ", depth double, seq string")
    found = prefix_trie.conversation_trie(df.repartition(5), heads=heads, local_rows=rows, local_turns=turns)
    assert rows_of(found) == plain_trie(plain_conversations(ODD)[heads])


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "MAX_BROADCAST", 0)
    found = prefix_trie.conversation_trie(spark.createDataFrame(ODD, KINDS), heads=True, local_rows=2)
    assert rows_of(found) == plain_trie(plain_conversations(ODD)[1])


def test_the_table_against_loops(spark):
    df = spark.read.parquet(f"{DATA}/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()]
    assert rows_of(prefix_trie.conversation_trie(df, heads=True, local_rows=4)) == plain_trie(plain_conversations(rows)[1])


def test_empty_and_turnless(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], KINDS), heads=True).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], KINDS), heads=True).count() == 0
    rows = [(c, 0, "a", "b") for c in (1, 2, 3, 4)]  # no conversation 0: those with h > 0 lose their only turn
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, KINDS), heads=True)
    expected = plain_conversations(rows)[1]
    assert any(not t for t in expected.values())
    assert rows_of(found) == plain_trie(expected)
