"""Incremental jobs as Structured Streaming.

I1: landed listing responses -> catalogue rows with READMEs. Which keys are known
is state of a streaming aggregate over the RocksDB store: the stored catalogue's
keys are a source of the first batch, and every key that a batch adds joins them,
so a batch looks up its own keys and reads neither the stored catalogue nor earlier
output. A run can be interrupted and resumed.

Micro-batches run in ``foreachBatch``. Each batch's
output goes to its own ``batch_id`` partition with dynamic overwrite, so a
replayed batch rewrites its own rows instead of duplicating them. Batches
are sized in files (``maxFilesPerTrigger``): land small files to get
about ``every`` rows per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.joins import attach_readme
from tessera.schemas import KEY, SAVE_EVERY
from tessera.sources.ingest import explode_listing, project_catalogue, to_catalogue

RESPONSE = T.StructType(
    [T.StructField("account", T.StringType()), T.StructField("page", T.LongType()), T.StructField("body", T.StringType())]
)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE = "spark.sql.streaming.stateStore.providerClass"


#: Stored keys, landed once beside the stream's own checkpoint.
KNOWN_KEYS = "known-keys"


def _land_known(spark: SparkSession, stored: DataFrame | None, checkpoint: str) -> DataFrame:
    """The stored catalogue's keys as a stream, written by the first run over a
    checkpoint; one without a stored catalogue writes none."""
    path = f"{checkpoint.rstrip('/')}/{KNOWN_KEYS}"
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    schema = ", ".join(f"{k} string" for k in KEY)
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        keys = spark.createDataFrame([], schema) if stored is None else stored.select(*KEY)
        for k in KEY:
            keys = keys.filter(F.length(F.col(k)) > 0)
        keys.write.mode("overwrite").parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def first_of_new_keys(items: DataFrame, known: DataFrame) -> DataFrame:
    """The first row by (page, pos) of each key that a batch is the first to hold
    (both frames are streams; in update mode). A batch has one time of its own,
    kept for its replay, so a key is new where its first time is its last; known
    keys are of the oldest time, whichever batch they come in."""
    row, at = F.struct(*items.columns), F.struct(F.current_timestamp().alias("at"), "page", "pos")
    rows = items.select(*KEY, row.alias("row"), at.alias("at"))
    none = rows.schema["row"].dataType
    old = F.struct(F.timestamp_seconds(F.lit(0)).alias("at"), F.lit(None).cast(items.schema["page"].dataType).alias("page"), F.lit(None).cast(items.schema["pos"].dataType).alias("pos"))
    both = rows.unionByName(known.select(*KEY, F.lit(None).cast(none).alias("row"), old.alias("at")))
    seen = both.groupBy(*KEY).agg(F.min_by("row", "at").alias("row"), F.min("at.at").alias("first"), F.max("at.at").alias("last"))
    return seen.filter("first = last AND row IS NOT NULL").select("row.*")


def _rocksdb(spark: SparkSession, start: Callable):
    """Start a query with the RocksDB state store, which holds state beyond the
    heap; the session's own setting stands again afterwards."""
    old = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        return start()
    finally:
        spark.conf.unset(STORE) if old is None else spark.conf.set(STORE, old)


def stream_catalogue(spark: SparkSession, landing: str, out_path: str, checkpoint: str,
                     stored: DataFrame | None = None, max_files: int | None = None,
                     readmes: DataFrame | None = None):
    """Run once over everything landed so far (``availableNow``) and
    return the finished query. New keys (J1: not in ``stored``, which the first
    run over a checkpoint takes in, nor in an earlier batch; the first of a
    batch's repeats stays) get their READMEs (J3) and are written to the batch's
    own ``batch_id`` partition. A batch that is replayed reads the state that it
    started from, so it writes the same rows again."""
    reader = spark.readStream.schema(RESPONSE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    items = to_catalogue(explode_listing(reader.json(landing)))
    new = first_of_new_keys(items, _land_known(spark, stored, checkpoint))

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = batch if readmes is None else attach_readme(batch, readmes)
        rows = project_catalogue(rows).withColumn("batch_id", F.lit(batch_id))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path)

    def start():
        query = new.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    return _rocksdb(spark, start)


def stream_enrich(spark: SparkSession, landing: str, schema: T.StructType, op: Callable[[DataFrame], DataFrame],
                  out_path: str, checkpoint: str, max_files: int = 1):
    """Apply ``op`` to each micro-batch of landed rows and save after
    every batch (and so at the end)."""

    def save(batch: DataFrame, batch_id: int) -> None:
        (
            op(batch)
            .withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(out_path)
        )

    q = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(landing)
        .writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


def land_in_small_files(df: DataFrame, path: str, rows_per_file: int = SAVE_EVERY) -> None:
    """Land rows as Parquet files of at most ``rows_per_file`` rows."""
    df.write.option("maxRecordsPerFile", rows_per_file).mode("append").parquet(path)


def checkpoint_embeddings(spark: SparkSession, landing: str, schema: T.StructType, factory, out_path: str,
                          checkpoint: str, max_files: int = 1):
    """I3 = I2 with the embedding step (M5 over pending rows)."""
    from tessera.plans.batch import embed_pending

    return stream_enrich(spark, landing, schema, lambda b: embed_pending(b, factory), out_path, checkpoint, max_files)
