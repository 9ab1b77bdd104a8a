"""Getting deliveries in and out: stream sources, the append sink, keyed publishing, line files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from reckon.operators.events import partition_key
from reckon.sources.tables import period

#: Rows that one micro-batch of a broker source may hold; a file source is bounded by files instead.
MOST_ROWS = 500_000


def broker_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", most: int = MOST_ROWS) -> DataFrame:
    """Deliveries of a topic; lost data is an error. Needs the Kafka source on the classpath."""
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return source.option("startingOffsets", starting).option("maxOffsetsPerTrigger", most).option("failOnDataLoss", "true").load()


def table_stream(spark: SparkSession, path: str, schema: str | StructType, files_per_batch: int = 10) -> DataFrame:
    """The appends of a parquet directory, so many files a micro-batch; a single file is a table of one."""
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    if file.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file).isFile():
        return source.option("pathGlobFilter", file.getName()).parquet(str(file.getParent()))
    return source.parquet(path)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(payload): the non-blank lines of JSON-lines files, stripped; a directory of ``*.json`` gives whole files in order of name."""
    if path.endswith((".jsonl", ".txt")):
        raw = spark.read.text(path).select(F.trim("value").alias("payload"))
    else:
        raw = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True).select("value", F.input_file_name().alias("f")).orderBy("f").select(F.btrim("value", F.lit(" \t\r\n")).alias("payload"))
    return raw.where("payload <> ''")


def keyed(payloads: DataFrame, partitions: int = 12, limit: int | None = None) -> DataFrame:
    """(key, value, headers, partition): payloads as deliveries, keyed by what they are about.

    A payload that isn't a JSON object stops the run; nothing is dropped. With ``limit`` only that
    many are sent.
    """
    rows = payloads if limit is None else payloads.limit(limit)
    checked = F.when(F.from_json("payload", "map<string,string>").isNull(), F.raise_error(F.lit("not a JSON object"))).otherwise(F.col("payload"))
    own = rows.select(partition_key("payload").alias("key"), checked.alias("value"))
    headers = F.create_map(F.lit("event_id"), F.get_json_object("value", "$.id"), F.lit("event_type"), F.get_json_object("value", "$.type"))
    return own.select("key", "value", headers.alias("headers"), F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"))


def publish(payloads: DataFrame, path: str, partitions: int = 12, limit: int | None = None) -> None:
    """Append keyed deliveries to a file topic, with an offset and a timestamp. Offsets rise within a write but aren't dense."""
    rows = keyed(payloads, partitions, limit)
    rows.select("*", F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp")).write.mode("append").parquet(path)


def broker_rows(payloads: DataFrame, limit: int | None = None) -> DataFrame:
    """(key, value, headers) as a broker's sink takes them; the broker places rows by key."""
    header = F.transform(F.map_entries("headers"), lambda e: F.struct(e["key"].alias("key"), F.coalesce(e["value"], F.lit("")).cast("binary").alias("value")))
    return keyed(payloads, limit=limit).select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), header.alias("headers"))


def publish_to_broker(payloads: DataFrame, servers: str, topic: str, limit: int | None = None, dry_run: bool = False) -> DataFrame:
    """Send keyed deliveries to a topic; gives (key, deliveries). A dry run checks and counts them without sending."""
    rows = broker_rows(payloads, limit)
    if not dry_run:
        rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").option("includeHeaders", "true").option("topic", topic).save()
    return rows.groupBy(F.col("key").cast("string").alias("key")).agg(F.count("value").alias("deliveries"))


def append(stream: DataFrame, path: str, checkpoint: str, by: str | None = "ingested_at", unit: str = "day", every: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet directory, partitioned by day or month of a time column.

    Drains what is there and stops, or runs on with a trigger ``every`` so long. The checkpoint
    decides where a restart goes on.
    """
    rows = stream if by is None else stream.select("*", period(by, unit))
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    if by is not None:
        writer = writer.partitionBy(f"{by}_{unit}")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
