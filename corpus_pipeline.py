"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Every stage works on all that its predecessor kept, and its decisions take effect: toxic documents go, of
each group of near duplicates the one with the smallest doc_id stays, contaminated documents go, secrets are
replaced in the text, and what is left becomes token ids. Rows without doc_id belong to no group and pass;
rows that share a doc_id are judged by their own texts, and of equal ones one stays. Null and empty texts pass
through all stages, very long ones are worked through whole; an empty table gives an empty result. All stages but
the last return the columns that they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billmill.llm import op1_jaccard_join as near
from billmill.llm import op5_decontaminate as benchmark
from billmill.llm import op6_toxicity as toxicity
from billmill.llm import op7_bpe as bpe
from billmill.llm import op10_secrets as secrets
from billmill.llm.ship import ship
from billmill.llm.steps import stored
from billmill.workspace import new_folder, recorded_steps, remove_steps


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.where(toxicity.toxic_score(F.col("text"), toxicity.learn(texts, labels)) < 0.5)


_OWN_IDS = 1 << 62  # ids from here on belong to rows whose doc_id several rows have


def _row_ids(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``: the doc_id, or for rows whose doc_id several rows have a number of doc_id and text.

    Rows that share a doc_id are thus texts of their own, and only equal ones share a number.
    """
    doc_id = F.col("doc_id").cast("long")
    counts = docs.select(doc_id.alias("_row")).where("_row is not null").groupBy("_row").count()
    repeated = stored(counts.where("count > 1").select("_row", F.lit(True).alias("_several")), "repeated-ids")
    docs = docs.withColumn("_row", doc_id)
    if repeated.isEmpty():
        return docs
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.lit(_OWN_IDS) + F.pmod(F.xxhash64("_row", text), F.lit(_OWN_IDS))
    named = docs.join(repeated, "_row", "left").withColumn("_row", F.when(F.col("_several"), own).otherwise(F.col("_row")))
    return stored(named.drop("_several"), "named-rows")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest doc_id (doc_ids of one row come first).

    Rows that share a doc_id but not the text are judged like rows of different doc_ids; of rows equal in both one
    stays. Rows without doc_id, text or words belong to no group and stay.
    """
    ship(spark)
    rows = _row_ids(docs)
    found = stored(near.jaccard_join(rows.select("_row", "text"), doc_id="_row"), "near-duplicates")
    found = found.where("doc_id is not null").withColumnRenamed("doc_id", "_row")
    others = found.where("component_id <> _row").select("_row")
    # Equal rows of one doc_id; only these few are gathered, one of each task before the shuffle.
    equal = found.where(f"component_id = _row and n_shingles > 0 and _row >= {_OWN_IDS}").groupBy("_row").count()
    equal = stored(equal.where("count > 1").select("_row"), "equal-rows")
    first = rows.join(equal, "_row", "left_semi").dropDuplicates(["_row"])
    # One join decides on all other rows, so their texts move once.
    rest = rows.join(stored(others.unionByName(equal).distinct(), "left-out-ids"), "_row", "left_anti")
    return rest.select(docs.columns).unionByName(first.select(docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not made of benchmark passages to a twentieth or more."""
    ship(spark)
    found = benchmark.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = stored(found.where("contaminated").select("doc_id", "text_hash").distinct(), "contaminated")
    bad = bad.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col("_hash")
    )
    return docs.join(bad, same, "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced; ``n_chars`` follows where a text changed."""
    ship(spark)
    if "n_chars" not in docs.columns:
        return secrets.redact(docs)
    clean = secrets.redact(docs.withColumn("_before", F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col("_before"))
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars"))).drop("_before")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of the ids and of the text decoded from them."""
    ship(spark)
    return bpe.digests(docs, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", encode),
]

# The stages' operators (learned weights, connected components, merges) go beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage has written down on its way goes as soon as its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, f"pipeline-{name}")
        with recorded_steps() as steps:
            stage(spark, docs, sf_dir).write.parquet(folder)
        remove_steps(spark, steps)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
