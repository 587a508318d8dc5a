"""A corpus pipeline of five stages; each one works on all rows that the one before it kept.

Each stage takes and returns the columns of ``documents``; the last one adds the ids. ``run`` applies all of them in order.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, jaccard, secrets, toxicity
from millrace.llm.shared import quoted, staged, table

def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon doesn't reject; it is learned from the labelled rows of ``documents``.

    Null and empty texts hold no evidence and stay; rows with the same text go or stay together, whatever their ids; an empty table stays empty.
    """
    lexicon = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.kept(docs, lexicon)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the least id; ids that aren't null come first.

    Rows are told apart by id and text, so rows that share an id, or have none, are judged by their own texts. Of rows with the same id and
    text one stays. Rows without words (null and empty texts) are no copies and stay; an empty table stays empty.
    """
    return jaccard.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item.

    Each row is judged by its own text; null and empty texts stay; benchmark items without words or text match nothing; an empty table stays empty.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets masked, and ``n_chars`` counted again.

    Null texts stay null, with a null ``n_chars``; a null source is one owner; repeated rows are masked alike; an empty table stays empty.
    """
    out = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*map(quoted, docs.columns))


def encode_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids (``ids``, ``n_tokens``) and the digest of the bytes that these decode to (``decoded_sha256``).

    A null text is empty: no ids, and the digest of no bytes. Columns of the documents that already have one of these three names are replaced; an empty table stays empty.
    """
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    own = ("ids", "n_tokens", "decoded_sha256")
    out = bpe.encode(docs.select(*(quoted(c) for c in docs.columns if c.lower() not in own)), path, public_tokenizers.PATTERN)
    out = bpe.decoded(out.withColumn("n_tokens", F.size("ids").cast("long")), path, "ids", "decoded_sha256")
    return out.withColumn("decoded_sha256", F.sha2("decoded_sha256", 256))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("byte_bpe", encode_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs)
    return docs


#: The learned lexicon and the byte-level merges can't be said in SQL.
ORACLE_SQL = None
