"""Stream sources (S7, S8) and the replay of table rows as stream input.

``ad_log_stream`` reads Kafka (value as text) or text files; both give one
``value`` string column, so every downstream function is the same.  The
Kafka connector jar is not bundled with PySpark; the reader stays a
parameter and the tests replay files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ad_log_stream(
    spark: SparkSession,
    path: str | None = None,
    kafka_options: dict[str, str] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of ad-log lines (column ``value``).

    With ``kafka_options`` (``kafka.bootstrap.servers``, ``subscribe``, ...)
    the lines come from Kafka; otherwise from text files under ``path``.
    """
    if kafka_options:
        return (spark.readStream.format("kafka").options(**kafka_options).load()
                .select(F.col("value").cast("string").alias("value")))
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select("value")


def socket_text_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket (column ``line``); for demos only, not fault tolerant."""
    return (spark.readStream.format("socket").option("host", host).option("port", str(port)).load()
            .withColumnRenamed("value", "line"))


def text_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files arriving under ``path`` (column ``line``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(F.col("value").alias("line"))


def write_replay_files(df: DataFrame, part: Column, order: Column, text_col: str, out_dir: str,
                       whole_parts: bool = False) -> int:
    """Write ``text_col`` as text files in one folder for each value of ``part``, with
    modification times that rise with ``part``; returns the number of files.

    A file stream picks files by modification time, so the replay arrives in
    ``part`` order, and inside a file in the rows' ``order``.  The number of files
    follows from the data: ``part`` values, and more files for a large one unless
    ``whole_parts`` asks for one file each.
    """
    rows = df.select(part.alias("part"), order.alias("__order"), F.col(text_col).alias("value"))
    rows = rows.repartition("part") if whole_parts else rows.hint("rebalance", "part")
    rows.sortWithinPartitions("part", "__order").select("part", "value").write.partitionBy("part").text(out_dir)
    spark = df.sparkSession
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(out_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files = []
    for folder in fs.listStatus(path):
        if folder.isDirectory() and folder.getPath().getName().startswith("part="):
            files += [(folder.getPath().getName(), f.getPath().getName(), f.getPath()) for f in fs.listStatus(folder.getPath())
                      if f.getPath().getName().startswith("part-")]
    files.sort(key=lambda f: f[:2])
    base = jvm.java.lang.System.currentTimeMillis() - 10_000 * (len(files) + 1)
    for i, (_, _, file) in enumerate(files):
        fs.setTimes(file, base + 10_000 * i, -1)
    return len(files)
