"""From raw documents to packed training sequences, in five stages.

Each stage takes all that the one before it kept and calls one operator of
``logweave.llm``: toxic documents go, of equal texts one stays, of near copies one
stays, sources are mixed to their weights (a document may come several times), and
the mix is packed.  Between stages the rows are a table in the shared scratch
folder, so a lost executor costs no more than the stage it was working on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweave.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from logweave.llm.queries import tokenizer_file
from logweave.plans.sizing import settled
from logweave.session import pin

# Near copies of the corpus; the query op7 has its own threshold.
NEAR_PER_CENT = 80


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_rows(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept_rows(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.kept_rows(docs, per_cent=NEAR_PER_CENT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# Token ids, learnt weights and window splits are not SQL's to express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the whole table of documents.

    Null and empty texts are equal to one another, so the exact dedup keeps one of
    them; it has no words and the mix takes it no oftener than its source's share
    says.  Of equal texts the row with the largest id stays, of near copies the one
    with the least; rows that repeat whole are copies.  A null source is a source,
    the last.  Texts of any length go through whole.  Without labels nothing is
    rejected.  An empty table gives no rows.  Further columns are carried along,
    whatever their names, up to packing.
    """
    pin(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
