"""Objects by key below a root folder: one JSON document each, written from the tasks, listed and read by Spark."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def put_objects(df: DataFrame, key: str, document: str, root: str, metadata: str | None = None) -> DataFrame:
    """key, ok, size_bytes, error, metadata: every document (JSON text) stored under root/key, indented, in UTF-8.

    An object that is there is replaced, and a task that runs again writes the same, so executors may be lost. A failure
    gives ok = false and never raises. metadata (a map column) goes into the result, which the caller keeps as manifest:
    file systems have no tags. Nothing is written until the result is used; null keys and documents give ok = false.
    """
    tags = (F.col(metadata) if metadata else F.create_map()).cast("map<string,string>").alias("metadata")
    base = df.select(F.col(key).cast("string").alias("key"), F.col(document).alias("document"), tags)
    schema = T.StructType([base.schema["key"], T.StructField("ok", T.BooleanType()), T.StructField("size_bytes", T.LongType()), T.StructField("error", T.StringType()), base.schema["metadata"]])

    def store(fs: pafs.FileSystem, folder: str, made: set[str], k: str | None, d: str | None) -> tuple[bool, int | None, str | None]:
        try:
            if not k or d is None:
                raise ValueError("no key or no document")
            body = json.dumps(json.loads(d), ensure_ascii=False, indent=2).encode()
            path = f"{folder}/{k}"
            if (parent := path.rsplit("/", 1)[0]) not in made:
                fs.create_dir(parent, recursive=True)
                made.add(parent)
            with fs.open_output_stream(path) as out:
                out.write(body)
            return True, len(body), None
        except Exception as e:
            return False, None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(root if "://" in root else root.removeprefix("file:"))
        made: set[str] = set()
        for b in batches:
            rows = [store(fs, folder, made, k, d) for k, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            ok, size, error = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ok, pa.bool_()), pa.array(size, pa.int64()), pa.array(error, pa.string()), b.column(2)], names=["key", "ok", "size_bytes", "error", "metadata"])

    return base.mapInArrow(run, schema)


def folder_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def list_objects(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """key, size_bytes of the objects whose key begins with prefix; no rows if there is no such root.

    Only file listings are read, never contents.
    """
    if not folder_exists(spark, root):
        return spark.createDataFrame([], "key string, size_bytes long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size_bytes"))
    base = root.split("://", 1)[-1].removeprefix("file:").rstrip("/")
    key = F.substring_index("path", base + "/", -1)
    return files.select(key.alias("key"), "size_bytes").where(F.col("key").startswith(prefix))
