"""Readers and writers of raw records. Security properties and addresses are the caller's options."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

RECORD = "topic string, key string, payload string, ts timestamp"


def kafka_options(servers: str, topics: list[str] | None = None, pattern: str | None = None, **extra: str) -> dict[str, str]:
    """Options for a list of topics (from the earliest offset) or a topic pattern (from the latest, with
    new topics found every minute). Offsets of a running query live in its checkpoint."""
    if bool(topics) == bool(pattern):
        raise ValueError("give either topics or a pattern")
    chosen = (
        {"subscribe": ",".join(topics), "startingOffsets": "earliest"}
        if topics
        else {"subscribePattern": pattern, "startingOffsets": "latest", "kafka.metadata.max.age.ms": "60000"}
    )
    return {"kafka.bootstrap.servers": servers, **chosen, **extra}


def records(kafka: DataFrame) -> DataFrame:
    """Kafka rows as records; a null value becomes an empty payload, which validation rejects."""
    return kafka.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.coalesce(F.col("value").cast("string"), F.lit("")).alias("payload"),
        F.col("timestamp").alias("ts"),
    )


def read_topics(spark: SparkSession, source_map: list[dict], streaming: bool = True) -> DataFrame:
    """One reader per cluster of ``source_map`` (see :func:`cluster_topics`) that has topics, as one stream of
    records; an empty one when no cluster has any."""
    readers = []
    for cluster in source_map:
        if not cluster["topics"]:
            continue
        options = kafka_options(cluster["bootstrap_servers"], topics=cluster["topics"], **cluster.get("properties", {}))
        reader = spark.readStream if streaming else spark.read
        readers.append(records(reader.format("kafka").options(**options).load()))
    if not readers:
        none = spark.readStream.format("rate").load() if streaming else spark.range(0)
        names = [part.split() for part in RECORD.split(", ")]
        return none.where("false").select(*[F.lit(None).cast(kind).alias(name) for name, kind in names])
    return reduce(DataFrame.unionByName, readers)


def read_pattern(spark: SparkSession, servers: str, pattern: str, streaming: bool = True, **extra: str) -> DataFrame:
    """The records of all topics whose name matches ``pattern``."""
    options = kafka_options(servers, pattern=pattern, **extra)
    if not streaming:
        options["startingOffsets"] = "earliest"
    return records((spark.readStream if streaming else spark.read).format("kafka").options(**options).load())


def cluster_topics(clusters: DataFrame, topics: DataFrame) -> DataFrame:
    """Topics per stream and cluster from the two configuration tables: enabled clusters with their
    enabled topics; a cluster without topics keeps an empty list.

    ``properties`` holds the reader options that the cluster's columns ``security_*`` and ``sasl_*`` set, such as
    ``kafka.security.protocol``; blank and null ones set none."""
    secured = sorted(c for c in clusters.columns if c.startswith(("security_", "sasl_")))
    named = F.array(*[F.struct(F.lit("kafka." + c.replace("_", ".")).alias("key"), F.trim(c).alias("value")) for c in secured])
    none = F.create_map().cast("map<string,string>")
    properties = F.map_from_entries(F.filter(named, lambda p: F.length(p["value"]) > 0)) if secured else none
    enabled = topics.where("enabled").select(F.col("cluster_config_id").alias("id"), F.trim("topic_name").alias("topic_name"))
    return (
        clusters.where("enabled")
        .withColumn("properties", properties)
        .join(enabled, "id", "left")
        .groupBy("stream_id", "cluster_name", "bootstrap_servers")
        .agg(F.array_sort(F.collect_set("topic_name")).alias("topics"), F.first("properties").alias("properties"))
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines in one file or folder per topic as records; the file name (or ``topic=`` folder) is the topic."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    lines = spark.read.text(path)
    if "topic" in lines.columns:
        return lines.select("topic", F.lit(None).cast("string").alias("key"), F.col("value").alias("payload"))
    return lines.select(
        F.regexp_replace(name, r"\.jsonl$", "").alias("topic"), F.lit(None).cast("string").alias("key"), F.col("value").alias("payload")
    )


def write_lines(df: DataFrame, path: str, payload: str = "payload", mode: str = "append") -> None:
    """Appends payload text, one folder per topic."""
    df.select("topic", F.col(payload).alias("value")).write.partitionBy("topic").mode(mode).text(path)


def stream_lines(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """The lines written by :func:`write_lines` as a stream of records."""
    raw = spark.readStream.schema("value string, topic string").option("maxFilesPerTrigger", files_per_batch).format("text").load(path)
    return raw.select("topic", F.lit(None).cast("string").alias("key"), F.col("value").alias("payload"))


def write_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str, **extra: str):
    """Starts an at-least-once query that writes ``value`` (and ``key``) to a topic."""
    writer = df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).options(**extra).start()


def read_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A configuration table over JDBC (schemas, rules, clusters, topics)."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()
