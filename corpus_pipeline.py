"""The corpus pipeline: documents in, a deduplicated, clean and weighted corpus out.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the next one's
documents. All stages but the last return the columns of documents; the last adds what the mix takes of each
document (size, source_size, target, taken) and keeps documents of which it takes nothing now, with taken = 0.

Defined results: a table without rows passes through; null texts count as empty; rows that repeat an id are
documents of their own, and so are those without an id, but of equal fingerprints within one group a single row
stays; columns beside those of documents are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm import decontam, mixing, pii, quality, simhash
from ordermill.llm.common import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# SQL cannot express the classifier, so the rows are tested against a brute-force version instead.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    classifier = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, classifier).filter("quality_predicted = 1").select(*COLUMNS)


def _unclear_ids(rows: DataFrame) -> DataFrame:
    """Ids that do not name one row: repeated ones, and null."""
    counted = rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL")
    return stored(counted.select(F.col("doc_id").alias("unclear_id")), "pipeline-ids")


def _is_unclear() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("unclear_id"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the smallest id, among equal ids with the smallest fingerprint.

    Documents go to the chosen ids in one shuffle; only those whose id is unclear are told apart by fingerprint.
    """
    own = docs.select(*COLUMNS)
    found = stored(simhash.near_duplicates(own), "pipeline-groups")
    unclear = _unclear_ids(found)
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = first.groupBy("root").agg(F.min("doc_id").alias("doc_id"), F.min("fp").alias("fp"))
    chosen = stored(chosen, "pipeline-chosen")
    clear = own.join(chosen.join(unclear, _is_unclear(), "left_anti").select("doc_id"), "doc_id", "left_semi")
    marked = simhash.fingerprints(own.join(unclear, _is_unclear(), "left_semi"), keep=COLUMNS)
    wanted = chosen.select(F.col("doc_id").alias("chosen_id"), F.col("fp").alias("chosen_fp"))
    same = F.col("doc_id").eqNullSafe(F.col("chosen_id")) & (F.col("fp") == F.col("chosen_fp"))
    others = marked.join(wanted, same, "left_semi").dropDuplicates(["doc_id", "fp"])
    return clear.unionByName(others.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.find_contamination(docs, benchmark, keep=COLUMNS)
    return found.filter(~decontam.contaminated()).select(*COLUMNS)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.sanitise(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of an unclear id are matched by source, size and number, which is exact: the mix asks for no more."""
    own = docs.select(*COLUMNS)
    taken = stored(mixing.words_taken(mixing.mix(own)), "pipeline-taken")
    unclear = _unclear_ids(taken)
    added = ["size", "source_size", "target", "taken"]
    known = taken.join(unclear, _is_unclear(), "left_anti").select("doc_id", *added)
    # Texts move once at any size; a broadcast would only fit small tables.
    clear = own.join(known.hint("merge"), "doc_id")

    def numbered(rows: DataFrame, *last: str) -> DataFrame:
        key = ["doc_id", "source", "size"]
        rows = rows.join(unclear, _is_unclear(), "left_semi")
        return rows.withColumn("number", F.row_number().over(Window.partitionBy(*key).orderBy(*last)))

    left = numbered(own.withColumn("size", mixing.size_of("text")), "text", "lang", "n_chars").alias("l")
    right = numbered(taken, "taken").alias("r")
    match = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("doc_id", "source", "size", "number")]
    others = left.join(right, match).select("l.*", "r.source_size", "r.target", "r.taken").drop("number")
    return clear.unionByName(others)


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("mixing sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
