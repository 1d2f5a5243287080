"""Landed objects, manifests and stream messages made from a table's rows, with faults planted at known shares.

What a row becomes is arithmetic on its key, so every verdict's count follows from the keys alone, at any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The fault of a key's remainder by FAULT_KEYS; the other remainders have none.
FAULT_KEYS = 20
FAULTS = ("CONTENT", "PART", "SIZE", "SHA", "MISSING", "FORMAT", "SMALL", "RESENT")
KINDS = ("pdf", "json", "las")


def fault(key: Column) -> Column:
    """The planted fault's name, or OK."""
    return F.coalesce(F.get(F.array(*map(F.lit, FAULTS)), (key % FAULT_KEYS).cast("int")), F.lit("OK"))


def kind(key: Column) -> Column:
    return F.get(F.array(*map(F.lit, KINDS)), (F.floor(key / FAULT_KEYS) % len(KINDS)).cast("int"))


def contents(key: Column) -> Column:
    """The text of a row's file: a one-page document, a sidecar or a well log, damaged where that is the key's fault."""
    bad, part, name = fault(key) == "CONTENT", fault(key) == "PART", key.cast("string")
    shown = F.concat(F.lit("BT 72 700 Td (Report "), name, F.lit(") Tj ET"))
    page = F.when(part, F.lit("")).otherwise(F.concat(F.lit("1 0 obj\n<< /Length "), F.length(shown).cast("string"), F.lit(" >>\nstream\n"), shown, F.lit("\nendstream\nendobj\n")))
    pdf = F.concat(F.lit("%PDF-1.4\n% "), name, F.lit("\n"), page, F.when(bad, F.lit("trailer")).otherwise(F.lit("trailer\n%%EOF\n")))
    video = F.when(part, F.lit("")).otherwise(F.concat(F.lit('"video_id": "v'), name, F.lit('", ')))
    json = F.concat(F.lit('{"pilot": "p'), name, F.lit('", '), video, F.lit('"file": "a.avi", "captured_at": "2026-01-01T00:00:00Z"'), F.when(bad, F.lit("")).otherwise(F.lit("}")))
    curves = F.when(part, F.lit("")).otherwise(F.lit("~C\nDEPT.M : d\nGR.API : g\n"))
    las = F.concat(F.lit("~V\nVERS. 2.0 : v\n~W\nWELL. W"), name, F.lit(" : n\nNULL. -999.25 : n\n"), curves, F.lit("~A\n1.0 "), F.when(bad, F.lit("none")).otherwise(F.lit("5.5")), F.lit("\n"))
    text = F.when(kind(key) == "pdf", pdf).when(kind(key) == "json", json).otherwise(las)
    return F.when(fault(key) == "SMALL", F.lit("~")).otherwise(text)


def landed(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(listed, objects): the manifest's rows (name, source, size, sha256) and the files that landed (file_name, size,
    sha256, content).

    A RESENT row's file has the bytes of the row after it under a name of its own.
    """
    k = F.col(key).cast("long")
    file = F.concat(F.lit("o"), k.cast("string"), F.lit("."), F.when(fault(k) == "FORMAT", F.lit("xyz")).otherwise(kind(k)))
    known = k + F.when(fault(k) == "RESENT", 1).otherwise(0)
    made = rows.select(k.alias("_k"), file.alias("file_name"), contents(known).cast("binary").alias("content"))
    made = made.select("_k", "file_name", F.length("content").cast("long").alias("size"), F.sha2("content", 256).alias("sha256"), "content")
    off = F.when(fault(F.col("_k")) == "SIZE", 1).otherwise(0)
    sha = F.when(fault(F.col("_k")) == "SHA", F.sha2(F.col("sha256"), 256)).otherwise(F.col("sha256"))
    listed = made.select(F.col("file_name").alias("name"), kind(F.col("_k")).alias("source"), (F.col("size") + off).alias("size"), sha.alias("sha256"))
    return listed, made.where(fault(F.col("_k")) != "MISSING").drop("_k")


#: Fixed values of the late producer: share of the messages, least and most seconds between reading and sending.
DELAYS = ((0.001, 900, 1800), (0.01, 120, 480), (0.02, 1, 4))


def _even(key: Column, factor: int) -> Column:
    """A number from 0 to 1 that looks drawn, by arithmetic on the key alone."""
    return (key.cast("long") * factor + 12345) % 2147483647 / 2147483647


def send_delay_ms(key: Column, delays: Sequence[tuple[float, int, int]] = DELAYS) -> Column:
    """Milliseconds between a reading and its sending: none for most, so messages come almost in the order of events;
    ``delays`` are shares of late ones and their range of seconds, the first shares first."""
    u, v = _even(key, 48271), _even(key, 69621)
    out, upto = F, 0.0
    for share, least, most in delays:
        upto += share
        out = out.when(u < upto, F.floor(1000 * (least + v * (most - least))))
    return out.otherwise(F.lit(0)).cast("long")


def sent_messages(readings: DataFrame, key: str, event: str, delays: Sequence[tuple[float, int, int]] = DELAYS) -> DataFrame:
    """Adds sent_ms, the time of sending in milliseconds; whoever reads in that order meets late readings."""
    return readings.withColumn("sent_ms", F.unix_millis(F.col(event).cast("timestamp")) + send_delay_ms(F.col(key), delays))
