"""Corpus cleaning in five stages, each reading what the one before it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from grainstone.cluster import delete_folder, shared_folder
from grainstone.llm import decontam, nearsets, packing, quality, toxicity
from grainstone.llm.labelled import remainder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour classifier takes for good.

    It is fitted on the labelled rows of the whole documents table whose key's remainder mod
    3 isn't 1, as in the query of that operator, and scores every row of docs: whole texts,
    however long; null and empty ones by the labelled rows' share. Equal texts stay or go
    alike, repeated rows too. Only the columns of documents are kept.
    """
    model = quality.fit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    return quality.keep(docs, model, 1).select(COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that compression with the toxic dictionary doesn't give away.

    Whole texts are scored, however long; null and empty ones have no window that gains.
    Equal texts stay or go alike, repeated rows too.
    """
    model = toxicity.fit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return toxicity.keep(docs, model, 0).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest key of each group of near copies.

    Copies are near at a Jaccard similarity of five-word shingles of 0.8 at least, compared
    exactly. SimHash and its vantage-point shards propose pairs first; the radius and shingles
    of operator 6's query hold for that query only, as copies at 0.8 lie further apart, and
    a prefix filter proposes the rest. Null, empty and wordless texts are one group; of rows
    with one key the first read stays; null keys come last.
    """
    return nearsets.representatives(docs).select(COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; null and empty texts have none."""
    return decontam.clean(docs, _table(spark, sf_dir, "benchmark")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of tokens; a null or empty text is only its end,
    and each of repeated rows is packed."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

#: The classifiers and the fingerprints can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet in the shared folder.

    What a stage wrote is deleted once the next one has written its own; the last stays, as
    the result is read from it. Empty tables go through all stages. Without usable labels no
    document counts as poor or toxic; without benchmark items none is contaminated.
    """
    docs, before = _table(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}-{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    return docs
