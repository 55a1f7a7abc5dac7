"""Load extracts as they arrive in a folder, with the batch reader and the batch load stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cohortloom.plans.runs import TableSpec, load_table
from cohortloom.plans.settings import Settings
from cohortloom.sources.extracts import read_extract
from cohortloom.sources.tables import ParquetStore


def follow_extracts(
    spark: SparkSession,
    spec: TableSpec,
    folder: str,
    store: ParquetStore,
    settings: Settings,
    checkpoint: str,
    sep: str = ",",
    multi_line: bool = False,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Load the files of a folder that were not loaded before, then stop.

    The stream only tells which files are new; their rows come from ``read_extract``, so a
    file is read here as it is in a batch run. A batch that is replayed after a failure appends
    nothing twice, because the load stage keeps only rows the target does not hold.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )

    def load(batch: DataFrame, _: int) -> None:
        paths = sorted(r.path for r in batch.collect())
        if paths:
            extract = read_extract(spark, paths, sep=sep, multi_line=multi_line, input_order=True)
            load_table(spec, extract, store, settings)

    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
