"""A corpus from raw documents, in stages; each is written as Parquet and reread by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of the documents.
"""

from pyspark.sql import DataFrame, SparkSession

from sleeveworks.llm import jaccard_join, line_cleaning, piece_transducer, raking, suffix_dedup
from sleeveworks.llm.queries import TOKENIZERS
from sleeveworks.session import new_shared_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go from the texts, and documents that fail go as a whole."""
    return line_cleaning.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its 5-word shingles."""
    return jaccard_join.one_of_each(docs, size=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes inside a 200-byte string that occurs again go from the texts."""
    return suffix_dedup.without_repeats(docs)


def target_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw that brings tokens by source, language and topic to their targets."""
    return raking.sample_mixture(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str, model_file: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> DataFrame:
    """The documents with their piece ids."""
    return piece_transducer.encode(docs, model_file)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing to target weights", target_mixture),
    ("SentencePiece encoding", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = new_shared_path(spark, f"stage{i + 1}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Groups of near copies, cut passages and piece ids can't be said in SQL; the tests compare them with
#: plain versions instead.
ORACLE_SQL = None
