"""Features of mails as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mailquarry.plans.pipeline import wide_features
from mailquarry.sources import mailfiles
from mailquarry.sources.eml import parse_mails
from mailquarry.sources.schema import PARSED

BINARY = "path string, modificationTime timestamp, length long, content binary"


def read_arriving(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of parsed mails from a folder of JSON lines."""
    reader = spark.readStream.schema(PARSED)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).json(path)


def note_arrived(spark: SparkSession, path: str, staging: str, glob: str | None = None, files_per_list: int | None = None) -> str:
    """Note the files at or below a folder that no earlier call has noted, in a table of lists under ``staging``; returns the table's path.

    Tasks list the folder and join what they found with the table; only counts reach the driver. What a call that fails has noted stands, and the next
    one notes the rest. One call at a time. A file without a byte is left for a later call.
    """
    lists = f"{staging.rstrip('/')}/arrived"
    spark.range(0).select(F.lit("").alias("path"), F.col("id").alias("modified"), F.col("id").alias("length")).write.mode("ignore").parquet(lists)
    noted = spark.read.schema(mailfiles.LISTED).parquet(lists).select("path")
    found = mailfiles.list_files(spark, path, staging, glob).where("length > 0")
    new = found.join(noted.hint("merge"), "path", "left_anti")  # a broadcast of the names would pass the driver
    n, size = new.agg(F.count("*"), F.sum(F.col("length") + mailfiles.OPEN_COST)).head()
    if n:
        n_lists = max(-(-size // mailfiles.PARTITION_BYTES), min(n, 2 * spark.sparkContext.defaultParallelism))
        most = min(files_per_list or mailfiles.LISTED_FILES, mailfiles.LISTED_FILES)
        new.repartition(n_lists, "path").write.mode("append").option("maxRecordsPerFile", most).parquet(lists)
    return lists


def read_arriving_files(spark: SparkSession, path: str, glob: str | None = None, files_per_trigger: int | None = None, label: str | None = None, staging: str | None = None) -> DataFrame:
    """A stream of the mails in files as they arrive at or below a folder: each file once, whatever its name, over any number of restarts.

    Spark's file stream keeps the names of the files it has read, in the driver's memory and with the query's checkpoint. A file must appear whole (moved
    into place, as ``mailfiles.write_files`` does); files without a byte are left out.

    With ``staging``, for folders of more files than a driver holds: the stream reads the lists of ``note_arrived``, which is called here; a stream that
    goes on takes what later calls note. The folder must be one that pyarrow reaches; ``staging`` lies outside it and belongs to it and to the query's checkpoint.
    """
    if staging:
        a_list = max(1, files_per_trigger // spark.sparkContext.defaultParallelism) if files_per_trigger else None
        lists = note_arrived(spark, path, staging, glob, a_list)
        listed = spark.readStream.schema(mailfiles.LISTED)
        listed = listed.option("maxFilesPerTrigger", max(1, files_per_trigger // a_list)) if files_per_trigger else listed
        return parse_mails(mailfiles.with_contents(listed.parquet(lists)), label)
    reader = spark.readStream.format("binaryFile").schema(BINARY).option("recursiveFileLookup", "true")
    for name, value in (("pathGlobFilter", glob), ("maxFilesPerTrigger", files_per_trigger)):
        reader = reader.option(name, value) if value else reader
    return parse_mails(reader.load(path), label)


def write_parsed(mails: DataFrame, target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """A stream of parsed mails to Parquet, each once. once: end when everything that is there now has been read."""
    writer = mails.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def write_features(mails: DataFrame, target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Wide features of a stream to Parquet, exactly once per mail. Each row stands alone, so there is no state and no watermark.

    once: end when everything that is there now has been read.
    """
    return write_parsed(wide_features(mails), target, checkpoint, once)
