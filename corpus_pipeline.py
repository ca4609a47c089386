"""From raw documents to packed sequences: the stages, and a run over all of them.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before has kept. Rows with null text
are rejected by the first stage; what each stage does with null ids and repeated rows is said by its operator.
"""

from pyspark.sql import functions as F

from larkspur.llm import jaccard, mixing, packing, pii, quality
from larkspur.session import new_path


def counted(docs):
    """n_chars of the text as it is now, where the documents have that column."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark, docs, sf_dir):
    return counted(quality.kept_docs(docs))


def near_duplicates(spark, docs, sf_dir):
    return jaccard.one_of_each(docs)


def personal_data(spark, docs, sf_dir):
    return counted(pii.redact(docs))


def mix_sources(spark, docs, sf_dir):
    """Weights of at least 0.9 of the largest entropy, with every source read whole at least once."""
    return mixing.mixed_docs(docs, entropy=0.9, budget=None)


def pack_sequences(spark, docs, sf_dir):
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]
#: Tokenizers, trees and similarity classes can't be put in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = new_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
