"""Cleaning of a text corpus in stages, each written as Parquet before the next begins.

A stage keeps the columns of ``documents`` until the last, which returns pieces
of packed sequences.  Rows that share an id and a text pass or fail together;
rows without an id pass every filter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkseries.llm.common import stored, table
from sparkseries.llm.linededup import deduplicate_lines
from sparkseries.llm.neardup import similar_documents
from sparkseries.llm.packing import pack
from sparkseries.llm.queries import fold, vocabulary_path
from sparkseries.llm.suffix import remove_repeats
from sparkseries.llm.toxicity import toxicity

Stage = tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]

TOXIC_FROM = 0.7
SIMILAR_FROM = 0.8
SHINGLE_WORDS = 5


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC_FROM``; the classifier learns from the labels' training part.

    Null and empty texts score low and stay.  Repeated rows share a score and
    fate; rows without an id are scored like others and stay if clean.  A long
    text is scored to its end.  Without labels of both kinds all documents stay.
    """
    labels = table(spark, sf_dir, "labels")
    scores = toxicity(docs, labels, fold("doc_id", 3) != 1, carry=tuple(docs.columns))
    return scores.where(F.col("score") < TOXIC_FROM).select("row.*")


def _cut(rows: DataFrame, columns: list[str], text: Column) -> DataFrame:
    """``columns`` of ``row``, with the text that is left and its number of characters."""
    own = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines of 20 characters or more that three documents hold, but for the last of them.

    Null becomes an empty text; no row goes.  Rows of one id are one holder;
    rows without an id hold nothing and keep all lines.  A text of any length is
    read to its end.  ``n_chars`` follows the text that is left.
    """
    others = tuple(c for c in docs.columns if c != "text")
    return _cut(deduplicate_lines(docs, carry=others), docs.columns, F.col("kept").cast("string"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of texts that share 0.8 of their 5-word shingles; rows of one id are one document.

    SimHash fingerprints within 3 bits name the first pairs; what lies farther
    apart and is still that similar is found by bands and rare shingles.

    Texts without words, null ones included, are copies of one another, so one
    of them stays.  Of equal ids all rows stay or go together; rows without an
    id all stay.  The whole text counts, whatever its length.
    """
    stays = similar_documents(docs, similarity=SIMILAR_FROM, words_per_shingle=SHINGLE_WORDS).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(stays, "doc_id", "left_semi").union(docs.where("doc_id IS NULL"))


def without_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 50 bytes that an earlier document has; a character cut in two becomes U+FFFD.

    Earlier means a smaller id.  Null becomes an empty text; no row goes.  Rows of
    one id do not judge each other; rows without an id stay whole and judge no
    others.  A long text is one chunk of its task with all its bytes.
    ``n_chars`` follows the text that is left.
    """
    others = tuple(c for c in docs.columns if c != "text")
    return _cut(remove_repeats(docs, carry=others), docs.columns, F.make_valid_utf8(F.col("kept").cast("string")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens.

    Null counts as empty, and an empty text is a piece of one id, the end mark.
    Repeated rows and rows without an id are documents of their own; a long text
    is cut into as many pieces as it needs.
    """
    return pack(docs, vocabulary_path())


STAGES: list[Stage] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("simhash", without_near_duplicates),
    ("suffix_dedup", without_repeated_strings),
    ("packing", packed),
]

#: tokens, trained classifiers and byte spans have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
