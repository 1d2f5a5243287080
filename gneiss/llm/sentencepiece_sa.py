"""SentencePiece encoding by suffix-array matching, and decoding.

New words of a batch are laid end to end and indexed by a suffix array over as many characters as the longest piece.
Every piece of the vocabulary is looked up by binary search; the range found gives all its places, each an edge of the
text. The edges are sorted by position and relaxed: for a byte-pair model the open edge of the best score whose two
halves stand side by side is taken, word by word, until none is open. Words are independent of each other wherever no
piece of the vocabulary spans their border, so their ids are kept in a bounded cache.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.common import bounded_batches
from gneiss.llm.tokens import decoded

MARK = "▁"
_FINE = regex.compile(rf"{MARK}*(?:\p{{L}}+|[^\p{{L}}{MARK}]+)|{MARK}+")
_COARSE = regex.compile(rf"{MARK}*[^{MARK}]+|{MARK}+")
_CACHE_WORDS, _CACHED_CHARS = 150_000, 64
#: Longer words are merged one by one with a heap instead of in rounds.
_LONG = 400


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _narrow(key: np.ndarray, low: np.ndarray, high: np.ndarray, value: np.ndarray, right: bool) -> np.ndarray:
    """searchsorted of each value within its own range [low, high) of key, which is sorted there."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        mid = (low + high) // 2
        at = key[np.minimum(mid, len(key) - 1)]
        up = open_ & ((at <= value) if right else (at < value))
        low = np.where(up, mid + 1, low)
        high = np.where(open_ & ~up, mid, high)
    return low


class Codec:
    """Encoder and decoder of a byte-pair sentencepiece file with byte fallback and a leading word mark."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        usable = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.chars = {self.pieces[i]: i for i in usable if len(self.pieces[i]) == 1}
        self.long = [i for i in usable if len(self.pieces[i]) > 1]
        scores = np.array([model.get_score(i) for i in self.long])
        if (scores != np.round(scores)).any():  # merge ranks are whole numbers, the log probabilities of other models are not
            raise ValueError(f"{path} is not a byte-pair model")
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.sizes = np.array([len(self.pieces[i]) for i in self.long], dtype=np.int64)
        self.width = int(self.sizes.max(initial=1))
        self.points = np.zeros((len(self.long), self.width), dtype=np.int64)
        for row, i in enumerate(self.long):
            self.points[row, : self.sizes[row]] = [ord(c) for c in self.pieces[i]]
        self.split = (_FINE if all(_FINE.fullmatch(self.pieces[i]) for i in self.long) else _COARSE).findall
        self.separable = all(_COARSE.fullmatch(self.pieces[i]) for i in self.long)
        self.text_of = [bytes([self.byte_of[i]]).decode("latin-1") if i in self.byte_of else p.replace(MARK, " ") for i, p in enumerate(self.pieces)]
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text code points, start, size, number in ``long``) of every place of every piece of two or more characters.

        Words stand apart by a zero, which is in no piece. Edges come sorted by position.
        """
        text = np.frombuffer(("\0".join(words) + "\0" * (self.width + 1)).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        alphabet, symbol = np.unique(text, return_inverse=True)
        bits = max(1, int(len(alphabet)).bit_length())
        per = 62 // bits
        n = len(text) - self.width
        keys = []
        for first in range(0, self.width, per):
            key = np.zeros(n, dtype=np.int64)
            for k in range(first, min(first + per, self.width)):
                key = (key << bits) | symbol[k : k + n]
            keys.append(key)
        array = np.lexsort(keys[::-1])
        keys = [k[array] for k in keys]
        code = np.searchsorted(alphabet, self.points)
        present = (alphabet[np.minimum(code, len(alphabet) - 1)] == self.points) | (np.arange(self.width) >= self.sizes[:, None])
        rows = np.flatnonzero(present.all(axis=1))
        low, high = np.zeros(len(rows), dtype=np.int64), np.full(len(rows), n, dtype=np.int64)
        for j, first in enumerate(range(0, self.width, per)):
            bottom, top = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
            for k in range(first, min(first + per, self.width)):
                inside = k < self.sizes[rows]
                bottom = (bottom << bits) | np.where(inside, code[rows, k], 0)
                top = (top << bits) | np.where(inside, code[rows, k], (1 << bits) - 1)
            if j == 0:
                low, high = np.searchsorted(keys[0], bottom, "left"), np.searchsorted(keys[0], top, "right")
            else:
                low, high = _narrow(keys[j], low, high, bottom, False), _narrow(keys[j], low, high, top, True)
            some = high > low
            rows, low, high = rows[some], low[some], high[some]
        count = high - low
        which = np.repeat(rows, count)
        start = array[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(which))]
        order = np.argsort(start, kind="stable")
        return text[:n], start[order], self.sizes[which[order]], which[order]

    def _merge_long(self, first: int, end: int, start: np.ndarray, stop: np.ndarray, which: np.ndarray, after: np.ndarray, taken: np.ndarray) -> None:
        """Merge one word with a heap of open edges; same result as the rounds."""
        known = {(int(s), int(e)): int(w) for s, e, w in zip(start, stop, which, strict=True)}
        before = {p: p - 1 for p in range(first, end)}
        heap: list[tuple[int, int, int, int]] = []

        def offer(s: int) -> None:
            m = int(after[s]) if s >= first else end
            if m < end and (w := known.get((s, int(after[m])))) is not None:
                heapq.heappush(heap, (int(self.rank[w]), s, m, int(after[m])))

        for p in range(first, end):
            offer(p)
        while heap:
            _, s, m, e = heapq.heappop(heap)
            if after[s] != m or after[m] != e:
                continue
            after[s], after[m], taken[s] = e, -1, known[s, e]
            if e < end:
                before[e] = s
            offer(before[s])
            offer(s)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word on its own, unsigned 32-bit little-endian."""
        text, start, size, which = self.edges(words)
        n = len(text)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        first = np.cumsum(lengths + 1) - lengths - 1
        after = np.arange(1, n + 1)  # where the symbol that begins here ends; -1 inside a symbol
        taken = np.full(n, -1, dtype=np.int64)  # the piece of the symbol that begins here
        stop, rank, owner = start + size, self.rank[which], np.searchsorted(first, start, "right") - 1
        for w in np.flatnonzero(lengths > _LONG):
            a, b = np.searchsorted(start, [first[w], first[w] + lengths[w]])
            self._merge_long(int(first[w]), int(first[w] + lengths[w]), start[a:b], stop[a:b], which[a:b], after, taken)
        live = np.flatnonzero(lengths[owner] <= _LONG)
        while live.size:
            s, e = start[live], stop[live]
            middle = after[s]
            usable = middle > 0
            # An edge is gone for good once its start is inside a symbol or that symbol has reached its end.
            alive = usable & (middle < e)
            live, s, e, middle = live[alive], s[alive], e[alive], middle[alive]
            ready = np.flatnonzero(after[middle] == e)
            if not ready.size:
                break
            of = owner[live[ready]]
            key = (rank[live[ready]] << 32) | s[ready]
            begin = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            best = np.minimum.reduceat(key, begin)
            chosen = ready[key == np.repeat(best, np.diff(np.concatenate([begin, [len(of)]])))]
            after[middle[chosen]] = -1
            after[s[chosen]] = e[chosen]
            taken[s[chosen]] = which[live[chosen]]
            moved = np.zeros(len(words), dtype=bool)
            moved[of] = True
            live = live[moved[owner[live]]]
        return self._ids(text, first, lengths, after, taken)

    def _ids(self, text: np.ndarray, first: np.ndarray, lengths: np.ndarray, after: np.ndarray, taken: np.ndarray) -> list[bytes]:
        points, inverse = np.unique(text, return_inverse=True)
        known = np.array([self.chars.get(chr(p), -1) if not 0xD800 <= p < 0xE000 else -1 for p in points])
        ids = np.where(taken >= 0, np.array(self.long)[taken], known[inverse])
        begins = after > 0
        begins[first + lengths] = False
        begins[len(text) - 1] &= bool(lengths[-1]) if len(lengths) else False
        at = np.flatnonzero(begins)
        values = ids[at]
        edge = np.searchsorted(at, np.concatenate([first, [len(text)]]))
        if (values >= 0).all():
            data = values.astype("<u4").tobytes()
            return [data[4 * a : 4 * b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
        out = []
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            row = []
            for v, p in zip(values[a:b].tolist(), text[at[a:b]].tolist(), strict=True):
                row += [v] if v >= 0 else [self.bytes[x] for x in chr(p).encode("utf-8", "replace")]
            out.append(np.array(row, dtype="<u4").tobytes())
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, unsigned 32-bit little-endian; the texts' new words are indexed together."""
        split = [self.split(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if not self.separable:
            split = [["".join(p)] if p else [] for p in split]
        new, old = self.new, self.old
        missing = list({w for p in split for w in p if w not in new})
        again = [w for w in missing if w in old]
        new.update((w, old[w]) for w in again)
        fresh = [w for w in missing if w not in new and "\0" not in w]
        if fresh:
            new.update(zip(fresh, self.encode_words(fresh), strict=True))
        for w in missing:
            if "\0" in w:
                new[w] = b"".join(self._around_zero(w))
        out = [b"".join(map(new.__getitem__, p)) for p in split]
        for w in missing:
            if len(w) > _CACHED_CHARS:
                del new[w]
        if len(new) > _CACHE_WORDS:
            self.old, self.new = new, {}
        return out

    def _around_zero(self, word: str) -> Iterator[bytes]:
        """A word with zero characters, which are in no piece: its parts, and the byte piece between them."""
        zero = np.array([self.bytes[0]], dtype="<u4").tobytes()
        for i, part in enumerate(word.split("\0")):
            if i:
                yield zero
            if part:
                yield from self.encode_words([part])

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, byte pieces as UTF-8, word marks as spaces, the leading one dropped."""
        table, byte_of = self.text_of, self.byte_of
        values = ids.tolist()
        if not byte_of or not any(map(byte_of.__contains__, set(values))):
            text = "".join([table[i] for i in values])
        else:
            parts: list[str] = []
            held = bytearray()
            for i in values:
                if i in byte_of:
                    held.append(byte_of[i])
                else:
                    if held:
                        parts.append(held.decode("utf-8", "replace"))
                        held.clear()
                    parts.append(table[i])
            parts.append(held.decode("utf-8", "replace"))
            text = "".join(parts)
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, with_ids: bool = True) -> DataFrame:
    """(id_col, n_pieces, ids binary, ids_crc32, text_crc32): ids of each whole text and the crc32 of the decoded ids.

    A null text counts as empty and has no ids. Ids may be null or repeat; other columns are ignored; an
    empty table gives no rows. The mark U+2581 in
    a text reads as a space, as in the file's own encoder. with_ids=False leaves the ids null.
    """
    bounded_batches(docs.sparkSession)
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in batches:
            ids = own.encode(decoded(b.column(1).cast(pa.binary()).to_pylist()))
            back = [zlib.crc32(own.decode(np.frombuffer(x, "<u4")).encode()) for x in ids]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids if with_ids else [None] * len(ids), pa.binary()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(back, pa.int64())], names=["id", "n_pieces", "ids", "ids_crc32", "text_crc32"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, n_pieces long, ids binary, ids_crc32 long, text_crc32 long").withColumnRenamed("id", id_col)


def decode_ids(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id_col, text) of binary ids; null ids give a null text."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in batches:
            texts = [None if x is None else own.decode(np.frombuffer(x, "<u4")) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    source = rows.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, text string").withColumnRenamed("id", id_col)
