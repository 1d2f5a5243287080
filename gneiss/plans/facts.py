"""The facts that a summary of some assets rests on: which assets, and the evidence of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.operators.joins import small
from gneiss.operators.windows import latest

#: Assets from the top of the worklist, days of work orders, work orders and chunks of a document at most.
TOP, ORDER_DAYS, ORDERS, CHUNKS = 15, 30, 40, 2


def focus(worklist: DataFrame, flagged: DataFrame, scope: DataFrame, tag: str, rank: str, top: int = TOP) -> DataFrame:
    """(tag): what a pre-screen flagged within the scope, and the top of the scope's worklist."""
    own = flagged.select(tag).join(small(scope.select(tag).distinct()), tag, "left_semi")
    return own.unionByName(worklist.where(F.col(rank) <= top).select(tag)).distinct()


def evidence(assets: DataFrame, inspections: DataFrame, orders: DataFrame, chunks: DataFrame, tag: str, doc: str, inspected: str, created: str, date: str, order: str) -> dict[str, DataFrame]:
    """For the assets of a focus at a date: inspections, the newest of each; orders, the newest of the last ORDER_DAYS days,
    ORDERS at most; chunks, the first CHUNKS of each newest inspection's document (chunk_no counts from 0).

    The assets are few (a pre-screen's and TOP), so they meet each table in a counted broadcast.
    """
    few, day = small(assets), F.to_date(F.lit(date))
    seen = inspections.join(few, tag, "left_semi").where(F.to_date(inspected) <= day)
    newest = latest(seen, [tag], [F.desc(inspected), F.desc(doc)])
    recent = orders.join(few, tag, "left_semi").where(F.to_date(created).between(F.date_sub(day, ORDER_DAYS), day))
    texts = chunks.where(F.col("chunk_no") < CHUNKS).join(small(newest.select(doc).distinct()), doc, "left_semi")
    return {"inspections": newest, "orders": recent.orderBy(F.desc(created), order).limit(ORDERS), "chunks": texts}
