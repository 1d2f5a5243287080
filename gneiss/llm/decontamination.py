"""Benchmark decontamination in DataFrame functions only: a hash set of benchmark windows, scanned over training texts.

A window is ``n`` consecutive words of an item, normalised; an item of fewer words is one window. The windows' hashes go
to every task as a bit table of bounded size, so a text is scanned where it is read and nothing of a clean one is
shuffled. Only windows whose bit is set leave their row; they are verified by their whole text in a join with the
windows, broadcast where their count allows it. Hits then name the items, and documents or spans to remove.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.llm.common import settle

WINDOW = 10
#: What stands between words, once A-Z are lower-cased: ASCII without letters and digits.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: The same in the text as it is, and what is a word there.
BETWEEN_AS_IS, WORD_AS_IS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of the table for each window, and longs of the table at most (512 KB); more windows only set more bits.
BITS_PER_WINDOW, MAX_LONGS = 64, 1 << 16
#: The windows are broadcast up to so many (window, item) pairs.
MAX_BROADCAST = 200_000


def normalised(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """The normalised words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(normalised(text), F.lit("")), BETWEEN), "")


def _hash_at(words: str, size: int):
    """Hash of the window of ``size`` words whose first word is x, at i."""
    return lambda x, i: F.xxhash64(x, *(F.get(F.col(words), i + k) for k in range(1, size)))


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """(size, window, hash, items): each distinct window, its words joined by spaces, and the ids of the items that have it.

    A null id's windows are scanned for as well, but name no item.
    """
    rows = benchmark.select(F.col(item_col).alias("item"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    rows = rows.withColumn("size", F.least(F.size("w"), F.lit(n)))
    windows = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1), lambda i: F.array_join(F.slice("w", i, F.col("size")), " "))
    rows = rows.select("size", F.explode(F.array_distinct(windows)).alias("window"), F.col("item").cast("string").alias("item"))
    return rows.groupBy("size", "window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def bit_table(windows: DataFrame) -> tuple[list[int], Column, int]:
    """The window sizes in use, the table as a constant array, and its longs.

    A window's bit is that of the hash of its words; a table has at most MAX_LONGS longs, whatever the benchmark.
    """
    count = windows.count()
    longs = 1
    while longs < MAX_LONGS and longs * 64 < BITS_PER_WINDOW * count:
        longs *= 2
    rows = windows.select("size", F.split("window", " ").alias("w"))
    sizes = sorted(r["size"] for r in rows.select("size").distinct().collect())  # at most n
    first = {s: _hash_at("w", s)(F.get("w", F.lit(0)), F.lit(0)) for s in sizes}
    rows = rows.select(reduce(lambda rest, s: F.when(F.col("size") == s, first[s]).otherwise(rest), sizes, F.lit(None).cast("long")).alias("h"))
    bits = rows.select(F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(longs - 1)).alias("at"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    found = {r["at"]: r["bits"] for r in bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect()}
    table = F.split(F.lit(",".join(str(found.get(i, 0)) for i in range(longs))), ",").cast("array<long>")  # folded to a constant
    return sizes, table, longs


def scan(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """(row, id, n_words, *keep, hits array<(start, size)>, items array<string>): one row per row of docs.

    ``row`` tells the rows of docs apart; hits are the verified windows by where they start (from 0).
    """
    keep = keep or {}
    windows = settle(windows)
    sizes, table, longs = bit_table(windows)
    df = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col).cast("string")).alias("w"), *(c.alias(k) for k, c in keep.items()))
    found = []
    for size in sizes:
        of = _hash_at("w", size)
        marked = lambda h: F.bit_get(F.get(table, F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(longs - 1)).cast("int")), h.bitwiseAND(F.lit(63)).cast("int")) == 1
        starts = F.slice("w", 1, F.greatest(F.size("w") - (size - 1), F.lit(0)))
        df = df.withColumn(f"h{size}", F.transform(starts, of))
        at = F.array_compact(F.transform(f"h{size}", lambda h, i: F.when(marked(h), i)))  # noqa: B023
        found.append(F.transform(at, lambda i: F.struct(i.alias("start"), F.lit(size).alias("size"), F.array_join(F.slice(F.col("w"), i + 1, F.lit(size)), " ").alias("window"))))  # noqa: B023
    none = F.array().cast("array<struct<start:int,size:int,window:string>>")
    df = df.select(F.monotonically_increasing_id().alias("row"), "id", F.size("w").cast("long").alias("n_words"), *keep, F.concat(none, *found).alias("maybe"))
    df = settle(df)  # so that row stays what it is
    own = ["row", "id", "n_words", *keep]
    hit = F.array().cast("array<struct<start:int,size:int>>").alias("hits"), F.array().cast("array<string>").alias("items")
    clean = df.where(F.size("maybe") == 0).select(*own, *hit)
    pairs = windows.agg(F.sum(F.size("items") + 1)).first()[0] or 0
    known = F.broadcast(windows) if pairs <= MAX_BROADCAST else windows
    maybe = df.where(F.size("maybe") > 0)
    there = maybe.select("row", F.explode("maybe").alias("m")).select("row", "m.*").join(known, ["size", "window"])
    hits = there.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "size"))).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    checked = maybe.select(*own).join(hits, "row", "left")
    return clean.unionByName(checked.select(*own, F.coalesce("hits", hit[0]).alias("hits"), F.coalesce("items", hit[1]).alias("items")))


def covered(hits: str) -> Column:
    """How many words lie in the windows of a sorted array of (start, size)."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(a: Column, h: Column) -> Column:
        end = F.greatest(a["end"], h["start"] + h["size"])
        return F.struct(end.alias("end"), (a["n"] + (end - F.greatest(a["end"], h["start"]))).cast("long").alias("n"))

    return F.aggregate(F.col(hits), zero, step, lambda a: a["n"])


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """(id_col, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of docs.

    A word inside any occurrence of a window is hit; items_sha256 is the hash of the ids of the items found, sorted as
    strings and joined by commas. A null or wordless text has no words and hits nothing, a null or wordless item has no
    window, and with an empty benchmark nothing is hit. Ids may be null or repeat, on either side: each row of docs gives
    a row, items of one id count once, an item without an id is scanned for but not named. Other columns are ignored; an
    empty table gives no rows.
    """
    found = scan(docs, benchmark_windows(benchmark, item_col, item_text_col, n), id_col, text_col)
    hit = covered("hits")
    columns = {"n_words": F.col("n_words"), "n_hit": hit, "n_items": F.size("items").cast("long"), "items_sha256": F.sha2(F.array_join("items", ","), 256), "contaminated": hit > 0}
    return found.select(F.col("id").alias(id_col), *(c.alias(k) for k, c in columns.items()))


def _key(id_col: str, text_col: str) -> list[Column]:
    """Names a row by its id and its text, up to repeated rows."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.col(id_col).isNull(), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.sha2(text, 256)]


def remove(docs: DataFrame, benchmark: DataFrame, spans: bool = False, most_hit: float = 0.0, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """docs without its contaminated rows or, with ``spans``, with the hit words taken out of their texts.

    A row is contaminated if more than the share ``most_hit`` of its words is hit. A word is taken out with what stands
    between it and the next one; all else of the text stays as it is. Columns, and rows that repeat, are those of docs.
    """
    kinds = ("_1", "_2", "_3")
    keys = dict(zip(kinds, _key(id_col, text_col), strict=True))
    found = scan(docs, benchmark_windows(benchmark, item_col, item_text_col, n), id_col, text_col, keys)
    hit = covered("hits")
    found = settle(found.where((hit > 0) & (hit > most_hit * F.col("n_words"))).select(*kinds, "hits").dropDuplicates(list(kinds)))
    names = [f"c{i}" for i in range(len(docs.columns))]  # free of clashes with the key's own names
    rows = docs.toDF(*names)
    id_, text = names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    rows = rows.withColumns(dict(zip(kinds, _key(id_, text), strict=True)))
    if not spans:
        return rows.join(found, list(kinds), "left_anti").select(*(F.col(a).alias(b) for a, b in zip(names, docs.columns, strict=True)))
    rows = rows.join(found, list(kinds), "left")
    gone = without(F.col(text).cast("string"), "hits")
    cut = F.when(F.col("hits").isNull(), F.col(text)).otherwise(gone)
    return rows.select(*((cut if a == text else F.col(a)).alias(b) for a, b in zip(names, docs.columns, strict=True)))


def without(text: Column, hits: str) -> Column:
    """The text without its hit words and what follows each of them."""
    words = F.array_remove(F.split(text, BETWEEN_AS_IS), "")
    between = F.split(text, WORD_AS_IS)  # before each word and after the last
    follows = F.zip_with(words, F.slice(between, 2, F.size(words)), lambda w, rest: F.concat(w, rest))
    hit = F.flatten(F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(words) - 1), hit)  # a hash set: linear in the words
    # An array of one struct, so that its fields are computed once and not again for each word.
    parts = F.transform(F.array(F.struct(between.alias("between"), follows.alias("follows"), kept.alias("kept"))), _joined)
    return F.get(parts, F.lit(0))


def _joined(x: Column) -> Column:
    return F.concat(F.get(x["between"], F.lit(0)), F.array_join(F.transform(x["kept"], lambda i: F.get(x["follows"], i)), ""))
