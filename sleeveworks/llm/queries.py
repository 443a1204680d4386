"""One query per operator over its whole table, with production parameters."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeveworks.llm import embedding_forest, host_reputation, jaccard_join, license_scan, line_cleaning, merge_automaton, merkle_manifest, periodic_runs, piece_transducer, raking, sharding, suffix_dedup, toxicity

#: Files of public tokenizers; they are read where they lie.
TOKENIZERS = "/opt/tokenizers"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document inside a 200-byte string that occurs again."""
    return suffix_dedup.removal_report(_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards, equal in rows and mixture."""
    return sharding.interleave(_table(spark, sf_dir, "documents"), shards=40)


def op3_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with a cosine of 0.98 or more."""
    return embedding_forest.near_vectors(_table(spark, sf_dir, "embeddings"))


def op4_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked probability and draw of every document."""
    return raking.mixture_report(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document."""
    return line_cleaning.quality_report(_table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page."""
    return host_reputation.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses found in every document."""
    return license_scan.licenses(_table(spark, sf_dir, "documents"))


def op9_pieces(spark: SparkSession, sf_dir: str, model_file: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_transducer.encode(docs, model_file).drop("text")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share nine tenths of their 3-word shingles."""
    return jaccard_join.similar_groups(_table(spark, sf_dir, "documents"), size=3, percent=90)


def op11_merge_automaton(spark: SparkSession, sf_dir: str, tokenizer_file: str = f"{TOKENIZERS}/byte_bpe_50k.json") -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = merge_automaton.encode(docs, tokenizer_file).drop("text")
    found = merge_automaton.decode(ids, tokenizer_file, text="decoded")
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def _planted(id: str, text: str) -> Column:
    """For about a tenth of the ids, the text's words from some place on repeat the first of them."""
    words = f"filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"
    g, n = f"(crc32(CAST({id} AS STRING)) div 10)", f"size({words})"
    a = f"CAST({g} % {n} AS INT)"
    period = f"CAST(1 + ({n} - {a}) div (3 + {g} % 8) AS INT)"
    tail = f"flatten(array_repeat(slice({words}, {a} + 1, {period}), CAST(ceil(({n} - {a}) / {period}) AS INT)))"
    changed = f"array_join(concat(slice({words}, 1, {a}), slice({tail}, 1, {n} - {a})), ' ')"
    return F.expr(f"CASE WHEN crc32(CAST({id} AS STRING)) % 10 = 0 AND {n} > 0 THEN {changed} ELSE {text} END")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in every document, some with planted ones, and what remains without the repeats."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", _planted("doc_id", "text").alias("text"))
    found = periodic_runs.collapse(docs)
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "collapsed", best.alias("best"), lines.alias("lines")).select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), "best.length", (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and root of every document, and whether its possibly tampered copy leads to the root."""
    docs = _table(spark, sf_dir, "documents")
    parts = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    altered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    tampered = [*parts[:3], F.when(altered, F.col("n_chars") + 1).otherwise(F.col("n_chars")), parts[4]]
    leaves = docs.select("doc_id", "lang", merkle_manifest.row_hash(parts).alias("leaf"), merkle_manifest.row_hash(tampered).alias("tampered"))
    proofs = merkle_manifest.manifest(leaves)
    found = proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle_manifest.siblings(F.col("path")), 256).alias("proof_sha256"),
                          merkle_manifest.fold(F.col("tampered"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_sharding": op2_sharding,
    "op3_embedding_forest": op3_embedding_forest,
    "op4_raking": op4_raking,
    "op5_toxicity": op5_toxicity,
    "op6_quality_rules": op6_quality_rules,
    "op7_url_filter": op7_url_filter,
    "op8_license_scan": op8_license_scan,
    "op9_pieces": op9_pieces,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_merge_automaton": op11_merge_automaton,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle_manifest": op13_merkle_manifest,
}
