"""The corpus pipeline: raw documents to packed token sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows of ``docs`` and gives a DataFrame; all but
the last give the columns of ``docs``. Its result is written as Parquet and read again for the
next stage. Null and empty texts, repeated rows and empty tables are treated as the stage's operator says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabprep.llm.decontaminate import remove_contaminated
from tabprep.llm.language import keep_identified
from tabprep.llm.packing import pack
from tabprep.llm.pii import redact
from tabprep.llm.shared import read_table, stored
from tabprep.llm.simhash import keep_one


#: Pieces that are packed together, with their ids: at most 4 MB. Words that a worker remembers: less than by default, since ids need the room.
GROUP_PIECES = 1024
REMEMBERED_BYTES = 32 << 20


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; without a letter there is none."""
    return keep_identified(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates (three words, three bits): that with the smallest id."""
    return keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item."""
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind."""
    return redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their token ids, in sequences of 1024 tokens."""
    return pack(docs, with_ids=True, group_pieces=GROUP_PIECES, remembered=REMEMBERED_BYTES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identified),
    ("near_duplicates", one_of_each),
    ("decontamination", uncontaminated),
    ("personal_data", redacted),
    ("packing", packed),
]

#: SQL has neither the language model, nor 64-bit hashes of shingles, nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
