"""Tables written between stages, where a later stage would compute one twice."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.sinks.files import Files


def staging_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one in local mode only.

    The temporary one goes with the process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="martflow-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a new Parquet table and read it back.

    The readers prune its columns, and a lost executor costs a reread instead
    of a recomputation.
    """
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_files(
    df: DataFrame, time: str, name: str, last: DataFrame | None = None, slices: int = 4, files: int = 4
) -> DataFrame:
    """Write ``df`` in slices of time and read it as a stream, one slice a micro-batch.

    The slices hold about as many rows each. All are written in one job and then dated
    one after the other, as a stream takes files by their age. ``last`` is a slice of its
    own, at the end.
    """
    spark = df.sparkSession
    df = stage(df, name)
    folder = f"{name}-{uuid.uuid4().hex}"
    path = f"{staging_dir(spark)}/{folder}"
    at = F.col(time)
    if dict(df.dtypes)[time] == "string":
        at = F.unix_millis(F.try_to_timestamp(at))
    shares = [i / slices for i in range(1, slices)]
    cuts = df.agg(F.percentile_approx(at, shares))
    cuts = cuts.first()[0] or []
    number = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: at > cut)) if cuts else F.lit(0)
    number = F.coalesce(number, F.lit(0)).alias("slice")
    place = F.col("slice") * files + F.pmod(F.xxhash64(time), F.lit(files))
    sliced = df.select("*", number).repartitionById(slices * files, place.cast("int"))
    sliced.write.partitionBy("slice").parquet(path)
    if last is not None:
        last.write.parquet(f"{path}/slice={slices}")
    written = Files(spark, path)
    spare = None
    for n, found in enumerate(f for f in written.listed() if f.is_folder):
        inner = [f.name for f in written.listed(found.name)]
        # A slice of few rows gets empty files, so that each is a micro-batch of its own.
        while len(inner) < files:
            if spare is None:
                df.limit(0).coalesce(1).write.parquet(f"{path}/none")
                spare = written.listed("none")[0].name
            inner.append(f"none-{len(inner)}.parquet")
            written.copy(f"none/{spare}", f"{found.name}/{inner[-1]}")
        for file in inner:
            written.date(f"{found.name}/{file}", 1_000_000_000_000 + n * 60_000)
    reader = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(f"{path}/slice=*")


def stage_stream(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over the input there is, and read back what it has written.

    What a watermark still holds open is not among it.
    """
    spark = stream.sparkSession
    path = f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", f"{path}/checkpoint")
    query = writer.trigger(availableNow=True).start(f"{path}/table")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def write_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to a folder of its own; a repeated one replaces itself."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return write


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What :func:`write_batches` wrote; no batch, no rows."""
    if not Files(spark, path).exists(""):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/batch=*")
