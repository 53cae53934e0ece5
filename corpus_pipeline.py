"""From raw documents to training tokens, in five stages.

Each stage takes the documents that the stage before it left, written as Parquet and read
again, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import op3_mixing, op6_toxicity, op8_near_dedup, op9_surrogates, op10_sentencepiece
from tickloom.llm.common import fresh, table, word_count
from tickloom.session import written

WORDS_OF_SHINGLE = 5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity of 0.5 or more; the model learns from given labels.

    Null and empty texts have the lowest toxicity and stay.
    """
    model = op6_toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    name = fresh(docs.columns, "score")
    return docs.withColumn(name, op6_toxicity.score(F.col("text"), model, spark)).filter(F.col(name) < 0.5).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near-equal documents the one of smallest id.

    Shingles have five words. Rows with the same id are kept or dropped together, but rows
    that are equal in id and text stay once. Documents without words and null ids stay.
    """
    found = op8_near_dedup.near_components(docs, "doc_id", "text", WORDS_OF_SHINGLE)
    dropped = found.filter("not kept").select("id").distinct()
    names = docs.columns
    id_name = fresh(names, "id")
    left = docs.join(dropped.withColumnRenamed("id", id_name), F.col("doc_id") == F.col(id_name), "left_anti")
    # of rows with one id: texts are compared by digest; rows of a null id or text are all kept
    digest, row, least = (fresh(names, n) for n in ("digest", "row", "least"))
    again = left.filter("doc_id is not null and text is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if again.isEmpty():
        return left.select(*names)
    repeated = left.join(again.drop("n"), "doc_id", "left_semi").withColumn(digest, F.sha2("text", 256))
    repeated = written(repeated.withColumn(row, F.monotonically_increasing_id()), "pipeline-repeated")
    firsts = repeated.groupBy("doc_id", digest).agg(F.min(row).alias(least))
    once = repeated.join(firsts.select(F.col(least)), F.col(row) == F.col(least), "left_semi")
    nulls = left.filter("doc_id is not null and text is null").join(again.drop("n"), "doc_id", "left_semi")
    once = once.filter("text is not null").select(*names).unionByName(nulls.select(*names))
    return left.join(again.drop("n"), "doc_id", "left_anti").select(*names).unionByName(once)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by surrogates; ``n_chars`` follows the new text."""
    made = op9_surrogates.replace_entities(docs, "text")
    return made.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else made


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources come to their target sizes.

    A document stands in the result as many times as it is taken, 0 to 2.
    """
    names = docs.columns
    row, size, copies, extra, key, part = (
        fresh(names, n) for n in ("row", "size", "copies", "again", "key", "part")
    )
    sized = docs.withColumns({row: F.xxhash64("doc_id", "text"), size: word_count(F.col("text"))})
    slim = written(sized.select(F.col(row).alias("row"), F.col("source").alias("source_of"), F.col(size).alias("size")), "pipeline-sizes")
    _, wanted = op3_mixing.source_targets(slim, "source_of", "size")
    mixed = op3_mixing.mix_copies(slim, "row", "source_of", "size", wanted, op3_mixing.MOST_COPIES)
    # equal rows share a key: each is taken the average of their copies, rounded half up
    shared = mixed.groupBy("row", "source_of").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n"))
    taken = shared.select(
        F.col("row").alias(key), F.col("source_of").alias(part), F.round(F.col("copies") / F.col("n")).cast("int").alias(copies)
    )
    joined = sized.join(taken, (F.col(row) == F.col(key)) & F.col("source").eqNullSafe(F.col(part))).filter(F.col(copies) > 0)
    repeats = F.explode(F.sequence(F.lit(1), F.col(copies))).alias(extra)
    return joined.select(*[F.col(f"`{c}`") for c in names], repeats).select(*names)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of whole texts by the SentencePiece model, and the number of characters they decode to."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    made = op10_sentencepiece.encode_documents(docs, "doc_id", "text", path)
    return made.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_pieces"),
        F.length("decoded").cast("long").alias("decoded_chars"),
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("surrogates", surrogates),
    ("mixing", mixing),
    ("tokens", tokens),
]

# A trained model and a randomised join cannot be told in SQL; tests compare each stage with
# a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
