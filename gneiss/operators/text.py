"""Text operators: chunks, labelled fields, tags, search, grounding, tickets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.operators.joins import small

#: What numbers look like, and what only seems to hold some: a day with or without its time, and a name (up to six letters,
#: a hyphen or an underscore, then a run with a digit in it). Commas may stand before groups of three digits.
NUMBER = r"-?\d+(?:,\d{3}\b)*(?:\.\d+)?"
DAY = r"\d{4}(?:-\d{2}){2}(?:[T ]\d{2}(?::\d{2}){1,2}Z?)?"
NAMED = r"\b\p{Alpha}{1,6}[_-][\w.-]*?\d[\w.-]*"
TICKET_TYPES = ("Inspection", "Repair", "Sensor", "Monitor")
PRIORITIES = ("High", "Medium", "Low")


def words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(inner, r"\s+"))


def chunks(df: DataFrame, key: str, text: str, size: int = 60, overlap: int = 15) -> DataFrame:
    """(key, chunk_no from 0, chunk): windows of ``size`` words, each starting ``size - overlap`` after the one before.

    The last one holds what is left; none begins inside the overlap of the one before that reached the end.
    """
    step = size - overlap
    df = df.select(key, words(F.col(text)).alias("_w")).where(F.size("_w") > 0)
    last = F.greatest(F.ceil((F.size("_w") - size) / step), F.lit(0)).cast("int")
    return df.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last))).select(key, "chunk_no", F.array_join(F.slice("_w", F.col("chunk_no") * step + 1, size), " ").alias("chunk"))


def fields(text: Column, patterns: Mapping[str, str]) -> list[Column]:
    """A column per labelled pattern (its first group), blanks collapsed, null where it does not occur."""
    found = {n: F.trim(F.regexp_replace(F.regexp_extract(text, p, 1), r"\s+", " ")) for n, p in patterns.items()}
    return [F.when(c != "", c).alias(n) for n, c in found.items()]


def tags(text: Column, pattern: str) -> Column:
    """Distinct matches in order of first occurrence."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def block(text: Column, heading: str, end: str = r"\n[ \t]*\n") -> Column:
    """What follows a heading up to a blank line (or another end) or the text's end; null without the heading."""
    found = F.regexp_extract(text, rf"(?s){heading}[^\n]*\n(.*?)(?:{end}|\z)", 1)
    return F.when(text.rlike(heading), found)


def snippet(text: Column, terms: Sequence[str], width: int = 320) -> Column:
    """The text around the first of the terms, line ends as blanks."""
    places = [F.instr(F.lower(text), t.lower()) for t in terms if len(t) > 2] or [F.lit(0)]
    first = F.coalesce(F.array_min(F.filter(F.array(*places), lambda p: p > 0)), F.lit(1))
    start = F.greatest(first - width // 3, F.lit(1))
    cut = F.replace(F.substr(text, start, F.lit(width)), F.lit("\n"), F.lit(" "))
    return F.concat(F.when(start > 1, "...").otherwise(""), cut, F.when(start + width <= F.length(text), "...").otherwise(""))


def numbers(text: Column) -> Column:
    """Numbers of a text as doubles, those inside days and names left out; read in one pass from left to right."""
    found = F.regexp_extract_all(text, F.lit(f"{DAY}|{NAMED}|({NUMBER})"), F.lit(1))
    return F.transform(F.filter(found, lambda x: x != ""), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double"))


def ungrounded(output: Column, context: Column) -> Column:
    """The output's decimals and integers from 10 on that no number of the context is near to.

    Near: within max(0.06, 1.1 %) of a context number, of its rounding to one digit, or of a share read as per cent.
    """
    base = numbers(context)
    pool = F.concat(base, F.transform(base, lambda c: F.round(c, 1)), F.transform(F.filter(base, lambda c: F.abs(c) < 1), lambda c: F.round(c * 100, 1)))
    checked = F.filter(numbers(output), lambda x: (x != F.floor(x)) | (F.abs(x) >= 10))
    return F.filter(checked, lambda x: ~F.exists(pool, lambda c: F.abs(x - c) <= F.greatest(F.lit(0.06), 0.011 * F.abs(c))))


CITATION = r"\[([^\[\]]+?) p\.\s*\d+\]"


def grounding(df: DataFrame, key: str, output: str, context: str, dimension: DataFrame, tag: str, pattern: str, files: str | None = None, max_share: float = 0.25, min_numbers: int = 4) -> DataFrame:
    """(key, rule, value, detail): what an output says that neither its context nor the dimension bears out.

    UNKNOWN_TAG: its tags (matches of ``pattern``) that are neither in the context nor in the dimension's column ``tag``.
    UNGROUNDED_NUMBER: the share of its checked numbers that no number of the context is near to, where it exceeds
    ``max_share`` of at least ``min_numbers``. With ``files``, an array of the files it was given: NO_CITATION where it
    cites none, FOREIGN_CITATION for cited ones that it was not given. Only tags that the context lacks meet the
    dimension, which is broadcast after a count or else joined on the tag. Keys are unique.
    """
    rows = df.select(key, F.coalesce(F.col(output), F.lit("")).alias("_out"), F.coalesce(F.col(context), F.lit("")).alias("_ctx"), *([F.col(files).alias("_files")] if files else []))
    told = rows.select(key, F.explode(F.array_except(tags(F.col("_out"), pattern), tags(F.col("_ctx"), pattern))).alias(tag))
    unknown = told.join(small(dimension.select(tag).distinct()), tag, "left_anti").groupBy(key).agg(
        F.count(F.lit(1)).cast("double").alias("value"), F.array_join(F.array_sort(F.collect_list(tag)), ", ").alias("detail"),
    )
    found = [unknown.select(key, F.lit("UNKNOWN_TAG").alias("rule"), "value", "detail")]
    checked = F.size(F.filter(numbers(F.col("_out")), lambda x: (x != F.floor(x)) | (F.abs(x) >= 10)))
    counts = rows.select(key, checked.alias("_n"), F.size(ungrounded(F.col("_out"), F.col("_ctx"))).alias("_bad"))
    share = counts.where((F.col("_n") >= min_numbers) & (F.col("_bad") > max_share * F.col("_n")))
    found.append(share.select(key, F.lit("UNGROUNDED_NUMBER").alias("rule"), F.round(F.col("_bad") / F.col("_n"), 3).alias("value"), F.concat(F.col("_bad").cast("string"), F.lit(" of "), F.col("_n").cast("string")).alias("detail")))
    if files:
        cited = F.array_distinct(F.regexp_extract_all("_out", F.lit(CITATION), F.lit(1)))
        cites = rows.select(key, "_files", cited.alias("_cited"), F.array_sort(F.array_except(cited, F.coalesce("_files", F.array().cast("array<string>")))).alias("_foreign"))
        none = cites.where((F.size("_files") > 0) & (F.size("_cited") == 0))
        found.append(none.select(key, F.lit("NO_CITATION").alias("rule"), F.lit(0.0).alias("value"), F.lit("").alias("detail")))
        foreign = cites.where(F.col("_files").isNotNull() & (F.size("_foreign") > 0))
        found.append(foreign.select(key, F.lit("FOREIGN_CITATION").alias("rule"), F.size("_foreign").cast("double").alias("value"), F.array_join("_foreign", ", ").alias("detail")))
    return reduce(DataFrame.unionByName, found)


def ticket_scope(drafts: DataFrame, assets: DataFrame, tag: str = "asset_tag", abstained: str = "is_abstained", forbidden: Sequence[str] = ()) -> DataFrame:
    """Adds scope (KEPT or DROPPED) and flags to ticket drafts: a tag that is no asset's is dropped, an abstained asset
    takes sensor tickets only, forbidden actions (patterns) are flagged. A tag's suffix .PV is left off."""
    own = drafts.withColumn(tag, F.regexp_replace(tag, r"\.PV$", ""))
    known = assets.groupBy(tag).agg(F.max(abstained).alias("_abstained"), F.lit(True).alias("_known"))
    both = own.join(small(known), tag, "left")
    told = F.lower(F.concat_ws(" ", "description", "evidence"))
    codes = [F.when(F.col("_known") & F.col("_abstained") & (F.col("ticket_type") != "Sensor"), "ABSTAINED_ASSET"), *(F.when(F.col("_known") & told.rlike(f"(?i){p}"), F.lit("FORBIDDEN_ACTION")) for p in forbidden)]
    flags = F.array_distinct(F.array_compact(F.array(*codes)))
    return both.withColumns({"scope": F.when(F.col("_known"), "KEPT").otherwise("DROPPED"), "flags": flags}).drop("_abstained", "_known")


def tickets(df: DataFrame, key: str, markdown: str) -> DataFrame:
    """A row per complete fenced ticket block: fields by label, types and priorities normalised, due days 1 to 180 (14)."""
    blocks = df.select(key, F.posexplode(F.regexp_extract_all(markdown, F.lit(r"(?is)```ticket\s*(.*?)```"), F.lit(1))).alias("ticket_no", "_b"))
    get = lambda name: F.trim(F.regexp_extract("_b", rf"(?im)^\s*(?:{name})\s*:\s*(.+?)\s*$", 1))
    plain = lambda c: F.lower(F.regexp_replace(c, r"^[`\"'<>\s]+|[`\"'<>\s]+$", ""))
    pick = lambda c, allowed: F.coalesce(*(F.when(plain(c) == a.lower(), a) for a in allowed))
    due = F.regexp_replace(get("due_in_days"), "[^0-9]", "").try_cast("bigint")
    out = blocks.select(
        key, "ticket_no", F.regexp_replace(get("asset_tag|tag|asset"), "^[`<>]+|[`<>]+$", "").alias("asset_tag"),
        pick(get("ticket_type|type"), TICKET_TYPES).alias("ticket_type"), F.coalesce(pick(get("priority"), PRIORITIES), F.lit("Medium")).alias("priority"),
        F.least(F.greatest(F.coalesce(due, F.lit(14)), F.lit(1)), F.lit(180)).cast("int").alias("due_in_days"), get("description").alias("description"),
        get("evidence").alias("evidence"),
    )
    return out.where("asset_tag <> '' and description <> '' and ticket_type is not null")


def plan(findings: DataFrame, tag: str, priority: Sequence[Column], most: int = 8) -> DataFrame:
    """The most urgent finding of each tag, at most ``most`` tags, in order."""
    w = Window.partitionBy(tag).orderBy(*priority)
    one = findings.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return one.orderBy(*priority).limit(most)
