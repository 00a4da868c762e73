"""A corpus pipeline of five stages: language, near duplicates, decontamination, secrets, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents; the last returns the training mix in its order, a row for
each time that a document is taken.

Each stage judges each row by its own text, so rows with a null or repeated doc_id are kept or go as any other. Null and
empty texts: language ID rejects them; the later stages keep them, if they get them, and the mix takes none of their words.
Very long texts are judged whole. Ties and repeated rows: near duplicates keep the row of least doc_id (null last), then of
least text key, and of wholly repeated rows one; the other stages treat each row alike. Extra columns are carried along
(of repeated rows, those of any one of them); in the mix, one named like an output of the mix is called document_<name>.
Empty tables: no rows, with the same columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalforge.llm.common import shared_folder, table
from signalforge.llm.contamination import uncontaminated
from signalforge.llm.jaccard_join import one_of_each_group
from signalforge.llm.language import LANG, SCORE, identified, learn, load_pieces
from signalforge.llm.mixing import assign, training_order
from signalforge.llm.secrets import default_model, redact

#: A document whose language is less sure than this is rejected, as is one without letters.
LEAST_SURE = 0.5
ORACLE_SQL = None  # learned models and union-find are beyond SQL; tests/llm hold the stages against brute force


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language stay; texts without a letter go."""
    pieces = load_pieces()
    found = identified(docs, learn(docs, pieces), pieces)
    return found.filter((F.col(LANG) != "und") & (F.col(SCORE) >= LEAST_SURE)).select(docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays, that of least id; texts without words stay."""
    return one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; every document stays."""
    return redact(docs, default_model())


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, range-sorted by training position: a row for each pass of a document; documents that it does not take go."""
    return training_order(assign(docs, keep=[c for c in docs.columns if c not in ("doc_id", "source")]))


STAGES = [("language ID", language), ("n-gram Jaccard join", near_duplicate), ("benchmark decontamination", decontaminate), ("secret scans", hide_secrets), ("mixing sources", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; what lies between them is written below spark.checkpoint.dir and stays there."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
