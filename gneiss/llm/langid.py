"""Language of a text: a linear-chain conditional random field over its words.

Each word has affix, character n-gram and lexicon features (hashed); a learned matrix scores passing from one word's
language to the next word's. Forward-backward gives each word's posterior, so a code-switched text has its words
labelled separately; a document's language has the largest mean posterior. The model is one small matrix.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from gneiss.llm.common import bounded_batches, id_remainder
from gneiss.llm.tokens import decoded

UNKNOWN = "und"
HOLD_OUT_MODULUS, HOLD_OUT = 3, 1
#: Learned from so many spans of text, drawn by a hash of the id and the span's place; together at most so many characters.
#: Where there are more languages than spans, from one span of each.
SAMPLE_DOCUMENTS, SAMPLE_CHARS = 1_200, 3_000_000
#: Feature rows of the weights are 2^17 or, with many languages, as many as keep features times languages within MODEL_CELLS.
FEATURE_BITS, MODEL_CELLS = 17, 1 << 23
_LETTERS = regex.compile(r"\p{L}+")
#: Words kept in a worker, their weights and their letters at most.
_CACHE_WORDS, _CACHE_CELLS, _CACHE_LETTERS = 300_000, 1 << 21, 40
#: Training texts laid end to end as one chain.
SPANS_IN_CHAIN = 4
#: Places of a chunk at least, chunks at most. With more than so many languages a text is not cut into chunks.
_CHUNK, _CHUNKS, _CHUNKED = 128, 8_192, 8
#: Words times languages that are labelled together; a longer text passes through in windows of that size.
_CELLS = 1 << 20


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _LETTERS.findall(text.lower())


def feature_bits(labels: int) -> int:
    """Of the weights for so many labels."""
    return max(1, min(FEATURE_BITS, (MODEL_CELLS // max(1, labels)).bit_length() - 1))


def features(words: list[str], bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of words: seven of each (the word itself for the lexicon, prefixes and suffixes of one to three
    letters), the trigrams of all words end to end, and how many trigrams each word has."""
    around = [f"^{w}$" for w in words]
    points = np.frombuffer("".join(around).encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.array([len(x) for x in around])
    last = np.cumsum(sizes) - 1
    first = last - sizes + 1
    fixed = [np.array([zlib.crc32(x.encode()) for x in around], dtype=np.uint64)]
    for edge, way in ((first, 1), (last, -1)):
        value = np.full(len(words), 3 + way, dtype=np.uint64)
        for k in (1, 2, 3):
            at = edge + way * k
            value = value * np.uint64(1_000_003) + np.where((at > first) & (at < last), points[np.clip(at, 0, len(points) - 1)], 0).astype(np.uint64) + np.uint64(1)
            fixed.append(value)
    inside = np.ones(len(points), bool)
    inside[last] = inside[last - 1] = False
    at = np.flatnonzero(inside)
    trigrams = (points[at] * np.uint64(1_000_003) + points[at + 1]) * np.uint64(1_000_003) + points[at + 2]
    place = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)
    return place(np.stack(fixed, axis=1)), place(trigrams), sizes - 2


@dataclass
class Model:
    """labels; weights (features by labels); transitions (from, to); start; all log-potentials."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    cache: dict = field(default_factory=dict, repr=False, compare=False)

    def emissions(self, words: list[str]) -> np.ndarray:
        """A row of log-potentials per word; words seen before come from a bounded cache, which keeps no long runs."""
        k = len(self.labels)
        if len(self.cache) > min(_CACHE_WORDS, _CACHE_CELLS // k):
            self.cache.clear()
        missing = list({w for w in words if w not in self.cache})
        if missing:
            fixed, trigrams, sizes = features(missing, len(self.weights).bit_length() - 1)
            sums = self.weights[fixed].sum(axis=1)
            ends = np.cumsum(sizes)
            step = max(1, 4 * _CELLS // k)
            for lo in range(0, len(trigrams), step):  # a run of letters may be very long
                first, last = np.searchsorted(ends, [lo, min(lo + step, len(trigrams)) - 1], "right")
                begin = np.maximum((ends - sizes)[first : last + 1] - lo, 0)
                sums[first : last + 1] += np.add.reduceat(self.weights[trigrams[lo : lo + step]], begin, axis=0)
            self.cache.update(zip(missing, sums, strict=True))
        out = np.array([self.cache[w] for w in words], dtype=np.float64).reshape(len(words), k)
        for w in missing:
            if len(w) > _CACHE_LETTERS:
                del self.cache[w]
        return out

    def means(self, words: list[list[str]]) -> np.ndarray:
        """The mean posterior of each text's words; every text has one. Long texts pass through in windows."""
        most = max(1, _CELLS // len(self.labels))
        if len(words) > 1 or len(words[0]) <= most:
            sizes = np.array([len(w) for w in words])
            starts = np.cumsum(sizes) - sizes
            first = np.zeros(sizes.sum(), bool)
            first[starts] = True
            p = forward_backward(self.emissions([w for ws in words for w in ws]), first, self.transitions, self.start)
            return np.add.reduceat(p, starts, axis=0) / sizes[:, None]
        (text,) = words
        windows = [text[lo : lo + most] for lo in range(0, len(text), most)]
        flags = [np.arange(len(w)) + i == 0 for i, w in enumerate(windows)]
        lefts: list = [None]
        for w, f in zip(windows[:-1], flags, strict=False):
            lefts.append(_pass(self.emissions(w), f, self.transitions, self.start, left=lefts[-1], only_forward=True)[1])
        total, right = 0.0, None
        for w, f, left in zip(reversed(windows), reversed(flags), reversed(lefts), strict=True):
            p, _, right = _pass(self.emissions(w), f, self.transitions, self.start, left=left, right=right)
            total = total + p.sum(axis=0)
        return (total / len(text))[None, :]


def forward_backward(emissions: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray, moves: np.ndarray | None = None) -> np.ndarray:
    """Posterior of each label at each place of many sequences laid end to end; ``first`` marks where one begins.

    ``moves``, if given, gets the expected number of steps from each label to each added to it.
    """
    return _pass(emissions, first, transitions, start, moves)[0] if len(emissions) else emissions


def _lanes(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of the pieces that advance together: equal chunks or, with many labels, whole sequences."""
    n = len(first)
    if k <= _CHUNKED:
        begin = np.arange(0, n, min(n, max(_CHUNK, -(-n // _CHUNKS))))
    else:
        begin = np.union1d(np.flatnonzero(first), [0])
    return begin, np.diff([*begin, n])


def _pass(emissions: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray, moves: np.ndarray | None = None, left: np.ndarray | None = None, right: np.ndarray | None = None, only_forward: bool = False) -> tuple[np.ndarray | None, np.ndarray, np.ndarray | None]:
    """(posteriors, forward vector after the last place, backward vector before the first).

    left and right are the vectors that a neighbouring window passes on. The pieces advance together. Where one does not
    begin a sequence, a first round finds each piece's transfer matrix and a short loop the vectors that come in.
    """
    n, k = emissions.shape
    begin, length = _lanes(first, k)
    lanes, size = len(begin), int(length.max())
    at = np.minimum(begin[:, None] + np.arange(size), n - 1)
    inside = np.arange(size) < length[:, None]
    e = np.exp(emissions - emissions.max(axis=1, keepdims=True))[at]
    e[~inside] = 1.0
    begins = first[at] & inside
    go, enter = np.exp(transitions - transitions.max()), np.exp(start - start.max())
    stopped = lambda t: np.flatnonzero(length <= t)  # noqa: E731  what is over passes vectors on unchanged

    def forward(v: np.ndarray, t: int) -> np.ndarray:
        """(lanes, ..., k) vectors from before place t to it."""
        out = v @ go
        new = np.flatnonzero(begins[:, t])
        out[new] = v[new].sum(axis=-1, keepdims=True) * enter
        out *= e[:, t].reshape(lanes, *[1] * (v.ndim - 2), k)
        over = stopped(t)
        out[over] = v[over]
        return out / out.sum(axis=tuple(range(1, v.ndim)), keepdims=True)

    def backward(v: np.ndarray, t: int) -> np.ndarray:
        after = e[:, t] * v
        out = after @ go.T
        new = np.flatnonzero(begins[:, t])
        out[new] = (after[new] * enter).sum(axis=1, keepdims=True)
        over = stopped(t)
        out[over] = v[over]
        return out / out.sum(axis=1, keepdims=True)

    even = np.full(k, 1 / k)
    cut = not first[begin[1:]].all()  # else what comes in says nothing, and one vector goes with each piece
    whole = np.broadcast_to(np.eye(k), (lanes, k, k)) if cut else None
    for t in range(size if cut else 0):
        whole = forward(whole, t)
    incoming = np.empty((lanes, k))
    incoming[:] = v = even if left is None else left
    for c in range(lanes if cut else 0):
        incoming[c] = v
        v = v @ whole[c]
        v = v / v.sum()
    if only_forward and cut:
        return None, v, None
    alpha, v = np.empty((lanes, size, k)), incoming
    for t in range(size):
        alpha[:, t] = v = forward(v, t)
    after = v[-1]
    if only_forward:
        return None, after, None
    incoming = np.empty((lanes, k))
    incoming[:] = even
    incoming[-1] = v = even if right is None else right
    for c in reversed(range(lanes if cut else 0)):
        incoming[c] = v
        v = whole[c] @ v
        v = v / v.sum()
    beta, v = np.empty((lanes, size, k)), incoming
    for t in reversed(range(size)):
        beta[:, t] = v
        v = backward(v, t)
    alpha, beta, e = alpha[inside], beta[inside], e[inside]
    if moves is not None:
        inner = np.flatnonzero(~first)
        inner = inner[inner > 0]
        come, leave = alpha[inner - 1], (e * beta)[inner]
        together = np.einsum("ti,ij,tj->t", come, go, leave, optimize=True)
        moves += go * ((come / together[:, None]).T @ leave)
    p = alpha * beta
    return p / p.sum(axis=1, keepdims=True), after, v[0]


class Chains:
    """Labelled words laid end to end as training data: their kinds, features and true labels, and where chains begin."""

    def __init__(self, docs: list[tuple[list[str], int]], labels: int, spans_in_chain: int):
        """docs: (words, label) of each text."""
        sizes = [len(ws) for ws, _ in docs]
        kinds: dict[str, int] = {}
        self.k = labels
        self.rows = np.array([kinds.setdefault(w, len(kinds)) for ws, _ in docs for w in ws], dtype=np.int64)
        self.gold = np.repeat(np.array([y for _, y in docs], dtype=np.int64), sizes)
        self.first = np.zeros(len(self.rows), bool)
        self.first[np.concatenate([[0], np.cumsum(sizes)[:-1]])[::spans_in_chain]] = True
        fixed, trigrams, counts = features(list(kinds), feature_bits(labels))
        self.n_kinds = len(kinds)
        self.flat = np.concatenate([fixed.ravel(), trigrams])
        self.owner = np.concatenate([np.repeat(np.arange(len(kinds)), fixed.shape[1]), np.repeat(np.arange(len(kinds)), counts)])
        inner = np.flatnonzero(~self.first)
        self.moved = np.zeros((self.k, self.k))
        np.add.at(self.moved, (self.gold[inner - 1], self.gold[inner]), 1)

    def gradient(self, weights: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the labels' log-likelihood: what is observed less what forward-backward expects, for weights, transitions, start."""
        each = range(self.k)
        e = np.stack([np.bincount(self.owner, weights=weights[self.flat, c], minlength=self.n_kinds) for c in each], axis=1)[self.rows]
        moves = np.zeros((self.k, self.k))
        off = np.eye(self.k)[self.gold] - forward_backward(e, self.first, transitions, start, moves)
        by_kind = np.stack([np.bincount(self.rows, weights=off[:, c], minlength=self.n_kinds) for c in each], axis=1)
        of_weights = np.stack([np.bincount(self.flat, weights=by_kind[self.owner, c], minlength=len(weights)) for c in each], axis=1)
        return of_weights, self.moved - moves, off[self.first].sum(axis=0)


def chain_groups(docs: list[tuple[list[str], int]], labels: int, spans_in_chain: int) -> list[Chains]:
    """Whole chains in groups of a bounded number of words times labels; one chain at least."""
    groups, held, cells = [], [], 0
    for lo in range(0, len(docs), spans_in_chain):
        chain = docs[lo : lo + spans_in_chain]
        own = labels * sum(len(w) for w, _ in chain)
        if held and cells + own > _CELLS:
            groups.append(Chains(held, labels, spans_in_chain))
            held, cells = [], 0
        held, cells = held + chain, cells + own
    return [*groups, Chains(held, labels, spans_in_chain)] if held else groups


def fit(texts: list[str], langs: list[str], rounds: int = 40, rate: float = 0.5, decay: float = 1e-6, chain_decay: float = 1e-4, spans_in_chain: int = SPANS_IN_CHAIN) -> Model:
    """Emissions, transitions and start together, by adaptive gradient steps up the chains' penalised log-likelihood.

    Every word bears its text's language. So many texts in the order given make a chain, so passing from one language to
    another is seen as well as staying; the penalty keeps moves that are never seen finite. Chains are summed over a
    bounded group at a time.
    """
    labels = sorted(set(langs))
    k, place = len(labels), {x: i for i, x in enumerate(labels)}
    rows = 1 << feature_bits(k)
    model = Model(labels, np.zeros((rows, k), dtype=np.float32), np.zeros((k, k)), np.zeros(k))
    docs = [(w, place[x]) for w, x in ((words_of(t), x) for t, x in zip(texts, langs, strict=True)) if w]
    if k < 2 or not docs:
        return model
    data = chain_groups(docs, k, spans_in_chain)
    n = sum(len(w) for w, _ in docs)
    values = [np.zeros((rows, k)), np.zeros((k, k)), np.zeros(k)]
    seen = [np.full(v.shape, 1e-8) for v in values]
    for i in range(rounds):
        total = [np.zeros(v.shape) for v in values]
        for part in data:
            for s, g in zip(total, part.gradient(*values), strict=True):
                s += g
        for v, s, g, d in zip(values, seen, total, (decay, chain_decay, chain_decay), strict=True):
            g = g / n - d * v
            s += g * g
            v += rate * g / np.sqrt(s) * (0.3 if i > rounds // 2 else 1.0)
    model.weights, model.transitions, model.start = values[0].astype(np.float32), values[1], values[2]
    return model


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_documents: int = SAMPLE_DOCUMENTS, sample_chars: int = SAMPLE_CHARS) -> Model | None:
    """Fit on a bounded sample of the text outside the held-out third; None without any.

    Documents are spans of ``sample_chars // sample_documents`` characters laid end to end, the last one shorter; most
    documents are one or two. Each language has the same number of spans, those of its smallest hashes, or all it has:
    neither a long document nor another language takes a place. Every language is learned; the driver holds them all.

    A span's hash is compared with a limit from its language's count of spans, a little above the share wanted, so a task
    passes on little more than what is taken. Only where repeated rows make hashes equal can fewer be found; that
    language is then drawn again without a limit, each task keeping its smallest hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}") & (id_remainder("id", HOLD_OUT_MODULUS) != HOLD_OUT))
    span = max(1, sample_chars // sample_documents)
    spans = F.ceil(F.length("text") / span).cast("int")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(spans.cast("long")).alias("n")).collect()}
    if not counts:
        return None
    # One language alone needs no model; two at least keep the draw small.
    each = max(1, sample_documents // max(2, len(counts)))
    wanted = (each + 8 * each**0.5 + 40) / np.array([counts[x] for x in sorted(counts)], dtype=np.float64)
    limits = dict(zip(sorted(counts), np.minimum(np.minimum(wanted, 1.0) * 2.0**64 - 2.0**63, 2.0**63 - 1024).astype(np.int64).tolist(), strict=True))
    found = _drawn(rows, spark, limits, spans, span, each)
    taken = Counter(lang for _, lang, _ in found)
    short = {x: (1 << 63) - 1 for x, n in counts.items() if taken[x] < min(each, n)}
    if short:
        found = [r for r in found if r[1] not in short] + _drawn(rows, spark, short, spans, span, each)
    found.sort()
    return fit([text for _, _, text in found], [lang for _, lang, _ in found])


def _drawn(rows: DataFrame, spark: SparkSession, limits: dict[str, int], spans: Column, span: int, each: int) -> list[tuple[int, str, str]]:
    """(hash, lang, text): each language's first spans of the order of their hashes, of those up to its limit."""
    few = spark.createDataFrame(list(limits.items()), "lang string, top long")  # a row for each language of the model
    draw = lambda i: F.xxhash64(F.lit("langid"), "id", i)
    places = F.filter(F.sequence(F.lit(0), spans - 1), lambda i: draw(i) <= F.col("top"))
    taken = F.transform(places, lambda i: F.struct(draw(i).alias("draw"), F.substring("text", i * span + 1, F.lit(span)).alias("text")))
    drawn = rows.join(F.broadcast(few), "lang").select("lang", F.explode(taken).alias("s")).select("lang", "s.*")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))
    return [(r["draw"], r["lang"], r["text"]) for r in drawn.withColumn("place", place).where(F.col("place") <= each).collect()]


def label_words(model: Model, text: str) -> list[tuple[str, str, float]]:
    """(word, language, posterior) of each word: the labels inside a code-switched text."""
    words = words_of(text)
    p = forward_backward(model.emissions(words), np.arange(len(words)) == 0, model.transitions, model.start)
    return [(w, model.labels[i], float(row[i])) for w, row, i in zip(words, p, p.argmax(axis=1) if len(words) else [], strict=True)]


def predict_texts(model: Model | None, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score of each text. Texts of like length are labelled together, a bounded group at a time."""
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    words = [words_of(t) for t in texts]
    order = sorted((i for i, w in enumerate(words) if w), key=lambda i: len(words[i])) if model else []
    even = model is not None and len(model.labels) <= _CHUNKED  # chunks are as long as each other, else lanes as the longest text
    held: list[int] = []
    places = 0
    for i, after in zip(order, [*order[1:], None], strict=True):
        held.append(i)
        places += len(words[i])
        if after is None or (places + len(words[after]) if even else (len(held) + 1) * len(words[after])) * len(model.labels) > _CELLS:
            for j, row in zip(held, model.means([words[j] for j in held]), strict=True):
                langs[j], scores[j] = model.labels[row.argmax()], float(min(1.0, row.max()))
            held, places = [], 0
    return langs, scores


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """docs' columns and lang_pred, score (their names must be free)."""
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # features by labels: a fixed size
    at = docs.columns.index(text_col)
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = predict_texts(held.value, decoded(b.column(at).cast(pa.binary()).to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*b.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id_col, held_out, lang_pred, score) for every row of docs.

    A text that is null or has no letter is ``und`` with score 0, as is every text if there is nothing to learn from.
    A null id is predicted too and its held_out is null; repeated rows each give a row; other columns are ignored; an
    empty table gives no rows.
    """
    model = train(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("id"), (id_remainder(id_col, HOLD_OUT_MODULUS) == HOLD_OUT).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    # Only short columns leave Python.
    bounded_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = predict_texts(held.value, decoded(b.column(2).cast(pa.binary()).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["id", "held_out", "lang_pred", "score"])

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_known(docs: DataFrame, least_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs whose language is found with at least ``least_score``, with docs' columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    found = identify(docs.toDF(*names), train(docs, id_col, text_col, lang_col), names[docs.columns.index(text_col)])
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score))
    return kept.select(*(F.col(a).alias(b) for a, b in zip(names, docs.columns, strict=True)))
