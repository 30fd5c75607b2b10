"""Raw listings that keep arriving: the batch cleaning applied to each new piece, and copies dropped across pieces."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotwise import vocab as V
from lotwise.plans.ingest import clean
from lotwise.sources.raw import read_raw

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def raw_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The names of CSV files that land in a folder; their content is read per micro-batch, by its header."""
    return spark.readStream.format("binaryFile").schema(_FILES).load(folder).select("path")


def append_cleaned(
    stream: DataFrame, market: str, root: str, checkpoint: str, as_of: str | None = None
) -> StreamingQuery:
    """Clean the files of every micro-batch and write the rows under the batch's own number.

    A batch that is repeated after a failure overwrites its own folder, so rows are stored exactly once.
    Copies are removed within a batch; ``append_firsts`` drops those of earlier batches. The driver gets the file
    names of one micro-batch.
    """
    if market.upper() == "US" and as_of is None:
        raise ValueError("US ages need the as_of time")

    def write(batch: DataFrame, number: int) -> None:
        files = sorted(r["path"] for r in batch.collect())
        if files:
            raw = read_raw(batch.sparkSession, files, market)
            clean(raw, market, as_of).write.mode("overwrite").parquet(f"{root}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def append_firsts(spark: SparkSession, market: str, cleaned: str, root: str, checkpoint: str) -> StreamingQuery:
    """Write those rows of ``append_cleaned``'s folder whose key no earlier row has, as cleaning all pieces at once would.

    The state store keeps, per key, where its first row stands: piece and position. Keys of a micro-batch come out
    with that place, and those whose place lies in an earlier piece were written before. Work grows with the new
    pieces, not with what is stored. A micro-batch that is repeated overwrites its own folder. Run it when
    ``append_cleaned`` has ended, so that pieces are taken in their order. Keys are all columns for DE and the
    columns of the batch rule for US; null keys are equal.
    """
    schema = spark.read.parquet(cleaned).schema
    own = [c for c in schema.names if c not in ("batch", "row_pos")]
    keys = own if market.upper() == "DE" else list(V.US_DEDUP_KEYS)
    stream = spark.readStream.schema(schema).parquet(cleaned)
    firsts = stream.groupBy(*keys).agg(F.min(F.struct("batch", "row_pos")).alias("first")).select("first.*")

    def write(found: DataFrame, number: int) -> None:
        session = found.sparkSession
        seen = _last_piece(session, root, number)
        rows = session.read.schema(schema).parquet(cleaned).where(F.col("batch") > seen)
        new = rows.join(found.where(F.col("batch") > seen), ["batch", "row_pos"], "left_semi")
        new.withColumnRenamed("batch", "piece").write.mode("overwrite").parquet(f"{root}/batch={number}")

    writer = firsts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _last_piece(spark: SparkSession, root: str, number: int) -> int:
    """The last piece that gave rows to a micro-batch before ``number``, -1 without one."""
    try:
        stored = spark.read.parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    last = stored.where(F.col("batch") < number).agg(F.max("piece")).first()[0]
    return -1 if last is None else last
