"""Word-piece token counts by a linear longest-match automaton.

A trie of the vocabulary gets failure links: from a node whose text matches no further, the link leads to where matching
goes on after the longest pieces are taken off, and how many pieces those are is stored with it. A word is read once,
left to right; counts add up on links and no piece is built. Many words step together.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.common import bounded_batches
from gneiss.llm.tokens import decoded

#: Words kept in a worker and their letters at most, so that the cache is bounded in bytes.
_CACHE_WORDS, _CACHE_LETTERS = 150_000, 64
_STEP = 1 << 21


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> tuple[list[str], list[str]]:
    """(pieces that begin a word, pieces that continue one) of a sentencepiece file: those with and without its word mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    begin = [p[1:] for p in pieces if p[0] == "▁" and len(p) > 1 and "▁" not in p[1:]]
    return begin, [p for p in pieces if "▁" not in p]


class Automaton:
    """Node 0 begins a word, node 1 continues one."""

    def __init__(self, begin: list[str], middle: list[str]):
        children: list[dict[str, int]] = [{}, {}]
        ends = [False, False]
        for root, pieces in ((0, begin), (1, middle)):
            for p in pieces:
                at = root
                for c in p:
                    if c not in children[at]:
                        children[at][c] = len(children)
                        children.append({})
                        ends.append(False)
                    at = children[at][c]
                ends[at] = True
        link, pops = [-1] * len(children), [0] * len(children)
        queue = deque([0, 1])
        while queue:
            u = queue.popleft()
            for c, v in children[u].items():
                if ends[v]:
                    link[v], pops[v] = 1, 1
                else:
                    z, popped = link[u], pops[u]
                    while z >= 0 and c not in children[z]:
                        popped += pops[z]
                        z = link[z]
                    if z >= 0:
                        link[v], pops[v] = children[z][c], popped
                queue.append(v)
        keys = np.array([u * _STEP + ord(c) for u, d in enumerate(children) for c in d], dtype=np.int64)
        values = np.array([v for d in children for v in d.values()], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.link, self.pops = np.array(link, dtype=np.int64), np.array(pops, dtype=np.int64)
        self.cache: dict[str, int] = {}

    def _go(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        key = nodes * _STEP + chars
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], -1)

    def counts(self, words: list[str]) -> np.ndarray:
        """Pieces of each word by greedy longest match; -1 for a word that has no such pieces."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        first = np.cumsum(sizes) - sizes
        node, total = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        live = order
        for t in range(int(sizes.max(initial=0))):
            live = live[: np.searchsorted(-sizes[live], -t, "left")]
            live = live[node[live] >= 0]
            todo, chars = live, points[first[live] + t]
            while todo.size:
                to = self._go(node[todo], chars)
                node[todo[to >= 0]] = to[to >= 0]
                todo, chars = todo[to < 0], chars[to < 0]
                total[todo] += self.pops[node[todo]]
                node[todo] = self.link[node[todo]]
                known = node[todo] >= 0
                todo, chars = todo[known], chars[known]
        todo = np.flatnonzero(node > 1)
        while todo.size:
            total[todo] += self.pops[node[todo]]
            node[todo] = self.link[node[todo]]
            todo = todo[node[todo] > 1]
        return np.where(node < 0, -1, total)

    def of(self, words: list[str]) -> list[int]:
        """``counts`` with a bounded cache of words, which keeps no long runs."""
        missing = list(set(words).difference(self.cache))
        if missing:
            self.cache.update(zip(missing, self.counts(missing).tolist(), strict=True))
        out = list(map(self.cache.__getitem__, words))
        for w in missing:
            if len(w) > _CACHE_LETTERS:
                del self.cache[w]
        if len(self.cache) > _CACHE_WORDS:
            self.cache.clear()
        return out


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    return Automaton(*vocabulary(path))


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id_col, n_words, n_tokens, n_unknown) of each whole text.

    Words are runs without white space (Unicode's); a word without a piecewise match is one unknown token. A null text
    counts as empty; ids may be null or repeat; other columns are ignored; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for b in batches:
            out = []
            for text in decoded(b.column(1).cast(pa.binary()).to_pylist()):
                found = machine.of(text.split())
                unknown = found.count(-1)
                out.append((len(found), sum(found) + 2 * unknown, unknown))
            columns = [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ((), (), ()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["id", "n_words", "n_tokens", "n_unknown"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, n_words long, n_tokens long, n_unknown long").withColumnRenamed("id", id_col)
