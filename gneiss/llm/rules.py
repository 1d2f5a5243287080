"""Quality rules in DataFrame functions only: base counts and distribution divergence.

A document's histograms of character classes and of common words are compared with those of each reference language
by Jensen-Shannon distance. A first pass finds each language's commonest words by the documents that hold them, a second
makes a short row of counts per document; everything after reads those rows. The references are sums over all documents
of a language that pass the base rules, taken twice: the second time without the documents whose classes are far from
every first reference.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.llm.common import settle

#: White space of the word pattern [^\x20\x09-\x0D]+.
SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"
#: Each value of lang is a reference language with so many common words, those that the most of its documents hold. A
#: common word has a letter and at most so many characters: a whole text of a script without spaces is not one.
COMMON_WORDS, COMMON_CHARS = 12, 64
#: References compared at once: so many cells of their word histograms make the constant arrays of one pass.
REFERENCE_CELLS = 1 << 19
N_CLASSES = 6
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: The class histogram is judged from so many characters on, the word histogram from so many words on.
MIN_CHARS, MIN_WORDS_JUDGED = 200, 100
#: Largest Jensen-Shannon distance (base 2, square root of the divergence) of the classes to a reference; to it comes
#: CLASS_NOISE over the square root of the text's length, the scale of a short text's chance deviations.
MAX_CLASS_DISTANCE, CLASS_NOISE = 0.17, 0.5
#: Largest distance of the words, as a share of the distance of a text without any common word.
MAX_WORD_SHARE = 0.98
#: References are summed again over the documents whose classes are so near to a first reference.
TRIM_DISTANCE = 0.15


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; empty for a text without one."""
    inner = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE))


def without(text: Column, pattern: str) -> Column:
    """Length of text in code points without the matches of pattern."""
    return F.length(F.regexp_replace(text, pattern, ""))


def repeated_words(df: DataFrame, words: str, out: str, window: int = 3) -> DataFrame:
    """Adds ``out``: how many words stand in a ``window``-word window found twice or more in the same text.

    Windows are compared by a 64-bit hash of their words. Each intermediate array is a column of its own that is used
    more than once, so the optimizer computes it once per row.
    """
    n = F.size(words)
    hashes = F.transform(F.slice(words, 1, F.greatest(n - (window - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *(F.get(F.col(words), i + k) for k in range(1, window))))
    df = df.withColumn("_hash", hashes)
    repeats = F.size(F.array_distinct("_hash")) < F.size("_hash")
    df = df.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform("_hash", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda e, k: F.coalesce(e["h"] == F.get(F.col("_sorted"), k)["h"], F.lit(False))
    df = df.withColumn("_at", F.sort_array(F.array_compact(F.transform("_sorted", lambda e, k: F.when(same(e, k - 1) | same(e, k + 1), e["i"])))))
    covered = F.transform("_at", lambda p, k: F.when(k == 0, F.lit(window)).otherwise(F.least(F.lit(window), p - F.get(F.col("_at"), k - 1))).cast("long"))
    return df.withColumn(out, F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))).drop("_hash", "_sorted", "_at")


def common_words(docs: DataFrame, text_col: str, lang_col: str, per_language: int = COMMON_WORDS) -> dict[str, list[str]]:
    """The words of each reference language that the most of its documents hold, ties by name: a few for each language.

    Counts are made over all documents and partly before they are shuffled; only each partition's first words of a
    language go on to the last ranking.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("t")).where("lang is not null and t is not null")
    words = rows.select("lang", F.explode(F.array_distinct(words_of(F.col("t")))).alias("word")).where(F.length("word") <= COMMON_CHARS)
    held = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")).where(F.col("word").rlike("\\p{L}"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    found = held.withColumn("place", place).where(F.col("place") <= per_language).select("lang", "word").collect()
    languages = {r["lang"]: [] for r in rows.select("lang").distinct().collect()}
    for r in found:
        languages[r["lang"]].append(r["word"])
    return {x: sorted(languages[x]) for x in sorted(languages)}


def counted_words(df: DataFrame, words: str, wanted: list[str], out: str) -> DataFrame:
    """Adds ``out``, an array of (at, n): how often a text holds each wanted word, by its place in the list, if at all.

    The wanted words of a text are sorted, so each word's occurrences stand together and are counted by where they begin.
    """
    df = df.withColumn("_sorted", F.sort_array(F.filter(words, lambda x: x.isin(wanted))) if wanted else F.array().cast("array<string>"))
    places = F.transform("_sorted", lambda x, i: F.when((i == 0) | (x != F.get(F.col("_sorted"), i - 1)), i))
    df = df.withColumn("_begins", F.array_compact(places))
    end = lambda k: F.coalesce(F.get(F.col("_begins"), k + 1), F.size("_sorted"))
    at = lambda p: (F.array_position(F.lit(wanted or [""]), F.get(F.col("_sorted"), p)) - 1).cast("int")
    counts = F.transform("_begins", lambda p, k: F.struct(at(p).alias("at"), (end(k) - p).cast("long").alias("n")))
    return df.withColumn(out, counts).drop("_sorted", "_begins")


def document_counts(docs: DataFrame, id_col: str, text_col: str, lang_col: str | None, wanted: list[str]) -> DataFrame:
    """One short row per document: base counts, character classes and counts of the wanted words."""
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    df = docs.select(F.col(id_col).alias("id"), lang.alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    df = df.withColumn("w", words_of(F.col("t"))).withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    df = counted_words(repeated_words(df, "w", "n_repeat_words"), "w", wanted, "hits")
    df = df.withColumn("n_chars", F.length("t")).withColumn("word_chars", F.length(F.array_join("w", "")))
    df = df.withColumn("n_symbols", F.regexp_count("t", F.lit(SYMBOLS))).withColumn("plain", without(F.col("t"), "[^\\p{L}\\p{N}\\x20\\x09-\\x0D]+"))
    long = {
        "n_words": F.size("w"),
        "word_chars": F.col("word_chars"),
        "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.col("n_repeat_words"),
        "n_chars": F.col("n_chars"),
        "plain": F.col("plain"),
        "upper": F.col("n_chars") - without(F.col("t"), "\\p{Lu}+"),
        "digits": F.col("n_chars") - without(F.col("t"), "\\p{N}+"),
    }
    df = df.select("id", "lang", *(v.cast("long").alias(k) for k, v in long.items()), "hits")
    space, other = F.col("n_chars") - F.col("word_chars"), F.col("n_chars") - F.col("plain") - F.col("n_symbols")
    classes = F.array(F.col("plain") - F.col("upper") - F.col("digits") - space, F.col("upper"), F.col("digits"), space, F.col("n_symbols"), other)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.select("id", "lang", *list(long)[:5], failed.alias("base_failed"), "n_chars", classes.alias("classes"), "hits")


@dataclass
class References:
    """Shares of the character classes and of the wanted words (the rest last), a row for each language with a passing
    document."""

    classes: list[list[float]]
    words: list[list[float]]

    def parts(self, cells: int = REFERENCE_CELLS) -> list[References]:
        """The references in groups of at most so many cells of word shares; one language at least."""
        step = max(1, cells // max(1, len(self.words[0]) if self.words else 1))
        return [References(self.classes[i : i + step], self.words[i : i + step]) for i in range(0, len(self.classes), step)]


def references(counts: DataFrame, n_wanted: int) -> References:
    """The references that the passing documents of each language make."""
    passing = counts.where(~F.col("base_failed") & F.col("lang").isNotNull())
    sums = [F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(N_CLASSES)]
    found = {r["lang"]: r for r in passing.groupBy("lang").agg(F.sum("n_words").alias("n"), *sums).collect()}
    words: dict[str, list[int]] = {x: [0] * n_wanted for x in found}
    hits = passing.select("lang", F.explode("hits").alias("h")).groupBy("lang", F.col("h.at").alias("at")).agg(F.sum("h.n").alias("n"))
    for r in hits.collect():  # a row for each language and wanted word at most
        words[r["lang"]][r["at"]] = r["n"]
    out = References([], [])
    for x in sorted(found):
        classes = [found[x][f"c{i}"] for i in range(N_CLASSES)]
        hits_of = [*words[x], found[x]["n"] - sum(words[x])]
        out.classes.append([n / sum(classes) for n in classes])
        out.words.append([n / sum(hits_of) for n in hits_of])
    return out


def constant(values: list[float]) -> Column:
    """An array of numbers that the optimizer folds into one literal."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _part(a: Column, b: Column) -> Column:
    return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))


def class_distances(shares: Column, refs: References) -> Column:
    """Square root of the Jensen-Shannon divergence in bits between an array of class shares and each reference's."""
    flat = constant([x for r in refs.classes for x in r])

    def distance(i: Column) -> Column:
        pairs = [(F.get(shares, F.lit(k)), F.get(flat, i * N_CLASSES + k)) for k in range(N_CLASSES)]
        return F.sqrt(F.greatest(F.lit(0.0), sum((_part(a, b) + _part(b, a) for a, b in pairs), F.lit(0.0)) / 2))

    return F.transform(F.sequence(F.lit(0), F.lit(len(refs.classes) - 1)), distance)


def word_distances(shares: Column, refs: References) -> Column:
    """The same for an array of (at, share) of the places that are not zero; each place that is adds its reference share."""
    width = len(refs.words[0])
    flat = constant([x for r in refs.words for x in r])
    term = lambda a, b: _part(a, b) + _part(b, a) - b

    def distance(i: Column) -> Column:
        total = F.aggregate(shares, F.lit(0.0), lambda s, x: s + term(x["share"], F.get(flat, i * width + x["at"])))
        return F.sqrt(F.greatest(F.lit(0.0), (F.lit(1.0) + total) / 2))

    return F.transform(F.sequence(F.lit(0), F.lit(len(refs.words) - 1)), distance)


def wordless_distance(reference: list[float]) -> float:
    """The distance of a text without wanted words: all its share is in the last place."""
    rest = reference[-1]
    spread = (1 - rest) + math.log2(2 / (1 + rest)) + (rest * math.log2(2 * rest / (1 + rest)) if rest else 0.0)
    return math.sqrt(spread / 2)


def with_shares(counts: DataFrame, n_wanted: int) -> DataFrame:
    """Adds the histograms: _class, an array of shares, and _word, (at, share) of the wanted words found and of the rest."""
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    rest = F.array(F.struct(F.lit(n_wanted).alias("at"), (F.col("n_words") - hit).alias("n")))
    share = lambda n, total: F.when(total > 0, n / F.greatest(total, F.lit(1))).otherwise(F.lit(0.0))
    words = F.transform(F.concat("hits", rest), lambda x: F.struct(x["at"].alias("at"), share(x["n"], F.col("n_words")).alias("share")))
    return counts.withColumns({"_class": F.transform("classes", lambda x: share(x, F.col("n_chars"))), "_word": words})


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", max_class_distance: float = MAX_CLASS_DISTANCE, max_word_share: float = MAX_WORD_SHARE) -> DataFrame:
    """Base counts, base_failed, the nearest reference's distances and kept, one row per row of docs.

    A null text has no words. kept is false where base_failed; else it is true if for some reference language both
    distances are within their limits. Histograms of fewer than MIN_CHARS characters or MIN_WORDS_JUDGED words are not
    judged; with no reference (no lang column, no document with a lang passes the base rules, or an empty table, which
    gives no rows) only the base rules judge. Every value of lang that a passing document has is a reference, however
    many there are; the driver holds their shares, and a pass compares with as many of them as make arrays of a bounded
    size. lang only groups the references, so a null lang is judged like any other. Ids may be null or repeat; other
    columns are ignored.
    """
    common = common_words(docs, text_col, lang_col) if lang_col else {}
    wanted = sorted({w for words in common.values() for w in words})
    counts = document_counts(docs, id_col, text_col, lang_col, wanted)
    counts = settle(with_shares(counts, len(wanted)))
    first = references(counts, len(wanted))
    near = counts.where(F.array_min(class_distances(F.col("_class"), first)) <= TRIM_DISTANCE) if first.classes else counts
    refs = references(near, len(wanted))
    df = counts.withColumns({"kept": F.lit(not refs.classes), "class_distance": F.lit(None).cast("double"), "word_distance": F.lit(None).cast("double")})
    for i, part in enumerate(refs.parts()):
        df = _compared(settle(df) if i else df, part, max_class_distance, max_word_share)  # a pass holds one group of references
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return df.select(F.col("id").alias(id_col), *base, (~F.col("base_failed") & F.col("kept")).alias("kept"), "class_distance", "word_distance")


def _compared(df: DataFrame, refs: References, max_class_distance: float, max_word_share: float) -> DataFrame:
    """Brings kept, class_distance and word_distance up to date with some of the references."""
    kept, limit = df.columns, constant([max_word_share * wordless_distance(w) for w in refs.words])
    most = F.lit(max_class_distance) + CLASS_NOISE / F.sqrt(F.greatest("n_chars", F.lit(1)))
    as_classes = lambda c: (F.col("n_chars") < MIN_CHARS) | (c <= most)
    as_words = lambda w, i: (F.col("n_words") < MIN_WORDS_JUDGED) | (w <= F.get(limit, i))
    df = df.withColumns({"_c": class_distances(F.col("_class"), refs), "_w": word_distances(F.col("_word"), refs)})
    fits = F.zip_with(F.transform("_c", as_classes), F.transform("_w", as_words), lambda x, y: x & y)
    df = df.withColumns({"kept": F.col("kept") | F.exists(fits, lambda x: x), "class_distance": F.least("class_distance", F.array_min("_c")), "word_distance": F.least("word_distance", F.array_min("_w"))})
    return df.select(*kept)
