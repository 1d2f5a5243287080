"""Corpus pipeline: quality classifier, language ID, SimHash near-dedup, packing.

Each stage works on all rows its predecessor kept. The filtering stages return the columns of documents; the last one
returns the packed pieces.
"""

from __future__ import annotations

import uuid

from gneiss.llm import langid, packing, quality, simhash
from gneiss.llm.common import shared_dir, table


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier accepts; it learns from the labels of this stage's input."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language_id(spark, docs, sf_dir):
    """Documents whose language is known."""
    return langid.keep_known(docs)


def near_dedup(spark, docs, sf_dir):
    """One document, that of the smallest id, of each group of near-duplicates."""
    return simhash.keep_one(docs)


def pack(spark, docs, sf_dir):
    """The pieces of all documents left, in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [("quality classifier", quality_classifier), ("language ID", language_id), ("SimHash near-dedup", near_dedup), ("packing", pack)]

#: Model fits, Hamming-distance components and the tokenizer have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows; the result of each stage before is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        found = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return found
        found.write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
