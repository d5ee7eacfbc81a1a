"""From raw documents to shards: stages that each apply one operator to what the last one kept.

Every stage is written as Parquet to the shared folder and read again, so a lost
executor costs one stage's tasks. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm import decontaminate, mixing, sharding, simhash, site_quality
from tablewright.llm.shared import new_path, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _packed(docs: DataFrame) -> DataFrame:
    """Each row as one column, so that no name of the table clashes with one used here."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Junk and toxic documents go: sources are hosts, a source's languages the paths below it."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = site_quality.fit(docs, labels)
    return site_quality.kept_documents(docs, model, F.col("source"), F.col("lang"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest id.

    Rows without an id cannot be that one unless no row of the component has an id;
    then, as where an id is repeated, one of them stays.
    """
    found = written(simhash.near_duplicates(docs), "near-duplicates").table
    leads = F.col("doc_id") == F.col("component_id")
    ids = found.groupBy(F.col("doc_id").alias("leader")).agg(
        F.count("*").alias("rows"), F.max(leads).alias("leads")
    )
    leaders = ids.where("leads").select("leader", "rows")
    packed = _packed(docs)
    led = packed.join(leaders, F.col("row.doc_id") == F.col("leader"))
    single = led.where("rows = 1").select("row")
    # Few rows share an id; only those are compared, as some may lead and others not.
    shared = found.where(leads).join(leaders.where("rows > 1"), F.col("doc_id") == F.col("leader"))
    shared = shared.groupBy(F.col("doc_id").alias("of"), "root").agg(F.min("fp").alias("fp"))
    repeated = led.where("rows > 1").withColumn("print", simhash.fingerprint_of("row.text"))
    repeated = repeated.join(shared, (F.col("leader") == F.col("of")) & (F.col("print") == F.col("fp")))
    repeated = repeated.dropDuplicates(["root"]).select("row")
    alone = found.where("component_id is null").select("fp", "root").distinct()
    nameless = packed.where("row.doc_id is null").withColumn("print", simhash.fingerprint_of("row.text"))
    nameless = nameless.join(alone, F.col("print") == F.col("fp")).dropDuplicates(["root"]).select("row")
    return single.unionByName(repeated).unionByName(nameless).select("row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go.

    Rows are judged by id and text, so those without an id are searched as well and
    texts that share an id each by itself.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _packed(docs).select("row", F.xxhash64("row.doc_id", "row.text").alias("key"))
    texts = keyed.select("key", F.col("row.text").alias("text"))
    leaked = decontaminate.contaminated(texts, items, id_col="key").select(F.col("doc_id").alias("leaked")).distinct()
    return keyed.join(leaked, F.col("key") == F.col("leaked"), "left_anti").select("row.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's run covers its first word: never, once or twice."""
    key = F.coalesce("row.doc_id", F.xxhash64("row.text", "row.source"))
    keyed = _packed(docs).select("row", key.alias("key"), mixing.word_count(F.col("row.text")).alias("size"))
    # Rows that share an id are told apart by their place among them.
    keyed = keyed.withColumn("nth", F.row_number().over(W.partitionBy("key").orderBy("size", "row.source")))
    sized = _packed(docs).select(key.alias("key"), F.col("row.text").alias("text"), F.col("row.source").alias("source"))
    mixed = mixing.mix(sized, id_col="key").select(F.col("doc_id").alias("of"), "size", "source", "copies")
    mixed = mixed.withColumn(
        "of_nth", F.row_number().over(W.partitionBy("of").orderBy("size", "source"))
    ).where("copies > 0")
    taken = keyed.join(mixed.select("of", "of_nth", "copies"), F.col("key") == F.col("of")).where("nth = of_nth")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and the place in it of every document."""
    return sharding.shard_documents(docs, sharding.text_dimensions(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", source_mix),
    ("k-d tree shards", shards),
]

#: XXH64 and CRC-32 have no SQL function, so the rows are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
