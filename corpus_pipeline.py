"""From raw documents to token shards: quality, near duplicates, decontamination, mixing, token ids.

Each stage takes the documents that its predecessor kept and returns documents with the same columns; the
last returns what it stored. Stages are written as Parquet and read again in between.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from orderflow.llm import repair
from orderflow.llm.common import table, written
from orderflow.llm.line_crf import quality
from orderflow.llm.lsh_forest import near_duplicates
from orderflow.llm.qgram_filter import without_leaks
from orderflow.llm.queries import QUALITY_LIMIT
from orderflow.llm.source_mix import mixed_documents

VOCABULARY = "word_bpe_49k.json"
# Labels mark texts; what the classifier learns and the mix are worked out by joins and sums, which SQL alone
# cannot repeat: tests/llm/test_pipeline.py compares each stage with a brute-force version.
ORACLE_SQL = None


def _free(name, columns):
    """The name, or one like it that no column has."""
    while name in columns:
        name += "_"
    return name


def good_documents(spark, docs, sf_dir):
    """Documents that the quality classifier accepts."""
    name = _free("quality_score", docs.columns)
    scores = quality(docs, table(spark, sf_dir, "labels"), keep=docs.columns, name=name)
    return scores.where(F.col(name) >= QUALITY_LIMIT).drop(name)


def distinct_documents(spark, docs, sf_dir):
    """One document of each group of near duplicates, the one with the least id. Of rows equal in id and text
    one stays; rows without an id stay."""
    found = near_duplicates(docs).where("doc_id IS NOT NULL")
    flags = found.groupBy(F.col("doc_id").alias("_id")).agg(F.bool_or(F.col("class_id") == F.col("doc_id")).alias("_stays"))
    flags = flags.where("_stays").select("_id")
    named = docs.where(F.col("doc_id").isNotNull()).select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"))
    rows = named.join(flags, "_id").withColumn("_text", F.xxhash64("_row.text"))
    one = F.row_number().over(W.partitionBy("_id", "_text").orderBy("_text"))
    rows = rows.withColumn("_n", one).where("_n = 1").select("_row.*")
    return rows.unionByName(docs.where(F.col("doc_id").isNull()))


def clean_documents(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark, docs, sf_dir):
    """The mix of sources by weight, a document as often as the mix takes it."""
    return mixed_documents(docs)


def token_shards(spark, docs, sf_dir):
    """Token shards in the order of ids, and per document what they hold."""
    import public_tokenizers

    return repair.decoded(repair.stored(docs, public_tokenizers.path(VOCABULARY)))


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", distinct_documents),
    ("benchmark decontamination", clean_documents),
    ("mixing sources to target weights", mixed_sources),
    ("token-ID output", token_shards),
]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
