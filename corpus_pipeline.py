"""The corpus pipeline: quality rules, near-duplicates, private data, source mix, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``. ``run`` writes each stage's rows
to the shared folder and goes on from there, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlespark.llm import mixing, near_dedup, packing, pii, quality_llr
from candlespark.llm.common import table
from candlespark.llm.queries import byte_bpe
from candlespark.session import configure, materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose n-grams are nearer to the trusted documents' than to the corpus'.

    Null, empty and very short texts fail; repeated rows are decided alike; an empty table stays empty; without labels only the base
    rules decide. The trusted ids come from ``labels`` of ``sf_dir``, the counts from ``docs``.
    """
    return quality_llr.keep_good(docs, table(configure(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shingles of five words, similarity 0.8; the smallest ``doc_id`` of each group stays.

    Of repeated rows one stays. Texts without words are linked with nothing and stay, one row per ``doc_id``; null ids stay if no
    row of their group has an id. An empty table stays empty.
    """
    configure(spark)
    return near_dedup.keep_one(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in place of personal data and ``n_chars`` counted anew.

    Null and empty texts stay as they are (a null text counts null characters); repeated rows get the same surrogates; an empty
    table stays empty.
    """
    configure(spark)
    safe = pii.protect(docs, key="corpus").drop("n_entities")
    return safe.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns) if "n_chars" in docs.columns else safe


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, zero to three times, shuffled; null sources are a source of their own.

    Null and empty texts have size 0; repeated rows are dealt one by one; an empty table stays empty.
    """
    configure(spark)
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2,048 tokens.

    Null and empty texts are one end token; repeated rows are packed one by one; an empty table gives no pieces.
    """
    configure(spark)
    return packing.pack(docs, *byte_bpe())


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("private_data", private_data),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

#: The hashed n-gram verdict, the surrogates' keyed digests and the packing search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
