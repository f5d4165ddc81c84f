"""A corpus pipeline: toxic documents go, then repeated lines, near copies and long repeated passages; the rest is packed.

Defined cases, in every stage but the last: rows keep all their columns, whatever their names; rows with null doc_id stay,
linked with nothing, and lose repeated lines and passages as others do; rows with one doc_id are one document where documents
are dropped, so they stay or go together; null texts stay null until passages are cut, where they become empty; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetmill.llm import jaccard, lines, packing, suffix, toxicity
from sheetmill.llm.common import checkpointed, table


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, if there, counted anew; null for null text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def ordinary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: without the documents that the models take for toxic."""
    return toxicity.keep_ordinary(docs, table(spark, sf_dir, "labels"))


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: without lines that repeat an earlier one, exactly or, from MIN_CHARS characters on, within one edit."""
    return counted(lines.dedup_lines(docs, short_copies=True))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of documents linked by four fifths of their five-word shingles the one with the smallest doc_id."""
    kept = jaccard.similar_components(docs).filter("doc_id <=> component_id").select(F.col("doc_id").alias("one"))
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["one"]), "left_semi")


def fresh_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: without bytes in 100-byte strings that start earlier. A text that repeats as a whole becomes empty."""
    others = tuple(c for c in docs.columns if c != "text")
    kept = suffix.remove_repeats(docs, with_text=True, carry=others)
    return counted(kept.select("rest.*", F.col("kept").alias("text"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the remaining texts' token pieces in sequences of at most 1024 tokens."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokenizer = f.read()
    return packing.pack(packing.pieces(docs, tokenizer), groups=packing.groups_for(docs))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", ordinary),
    ("line dedup", fresh_lines),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", fresh_passages),
    ("best-fit packing", packed),
]

#: Language models, tokens and packing are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in their order over documents, each on a checkpoint of what its predecessor kept."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if i == 0 else checkpointed(docs), sf_dir)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
