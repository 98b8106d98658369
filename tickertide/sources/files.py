"""Small files and folders of the shared store, by Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str) -> tuple[object, object]:
    """A path and the store it is in."""
    java = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return java, java.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is none."""
    java, store = hadoop_path(spark, path)
    found = [s.getPath().getName() for s in store.listStatus(java)] if store.exists(java) else []
    return [n for n in found if not n.startswith(".")]


def put_file(spark: SparkSession, path: str, content: bytes) -> None:
    java, store = hadoop_path(spark, path)
    store.mkdirs(java.getParent())
    out = store.create(java, False)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def take_name(spark: SparkSession, draft: str, name: str) -> bool:
    """Give a file its name unless that is taken; False if it is. The draft is gone then."""
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    source, store = hadoop_path(spark, draft)
    target, _ = hadoop_path(spark, name)
    context = jvm.FileContext.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(source, target, spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0))
    except Exception:
        store.delete(source, False)
        if not store.exists(target):
            raise
        return False
    return True


def drop(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds."""
    java, store = hadoop_path(spark, path)
    store.delete(java, True)
