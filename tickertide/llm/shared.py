"""Sorted arrays in files that all executors share, memory-mapped by the tasks that ask them.

Rows with a 64-bit key are cut into shards by the leading bits of the key. One task writes
each shard, sorted, under its final name only once it is whole, so a task that runs again
writes the same file again. Tasks that look keys up map the shards they need. The folder is
below ``spark.checkpoint.dir``; where that is a store without mounting, shards are read
into memory instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickertide.session import TASK_BYTES, scratch_path

U64 = np.uint64
MOST_BITS = 20  # of a key that name a shard
UNKNOWN_BYTES = 1 << 60


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder that the driver and all executors reach."""
    path = scratch_path(spark, name)
    return path if "://" in path or path.startswith("file:") else f"file:{path}"


def place(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:") or uri.startswith("/"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_bytes(uri: str, fill: Callable[[pa.NativeFile], None]) -> None:
    """A file that has its name only when it is whole."""
    store, path = place(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        fill(out)
    store.move(draft, path)


def write_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Arrays of one length as one file that can be mapped."""
    batch = pa.record_batch([pa.array(a) for a in arrays.values()], names=list(arrays))

    def fill(out: pa.NativeFile) -> None:
        with pa.ipc.new_file(out, batch.schema) as file:
            file.write_batch(batch)

    write_bytes(uri, fill)


def open_file(uri: str) -> pa.NativeFile:
    store, path = place(uri)
    return pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)


@lru_cache(maxsize=256)
def read_arrays(uri: str) -> dict[str, np.ndarray]:
    file = pa.ipc.open_file(open_file(uri))
    if not file.num_record_batches:
        return {f.name: np.zeros(0, f.type.to_pandas_dtype()) for f in file.schema}
    batch = file.get_batch(0)
    return {n: c.to_numpy(zero_copy_only=True) for n, c in zip(batch.schema.names, batch.columns)}


@lru_cache(maxsize=64)
def listed(folder: str) -> frozenset[str]:
    """The files of a folder that is complete."""
    store, path = place(folder)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return frozenset(x.base_name for x in found)


def shard_bits(spark: SparkSession) -> int:
    """Bits of the key that name a shard: a shard or more for each shuffle partition."""
    return max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def bits_for(rows: DataFrame) -> int:
    """As ``shard_bits``, but a shard or more for each ``TASK_BYTES`` / 2 of input files.

    Rows that Spark knows no size of, such as checkpoints, leave it at ``shard_bits``."""
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    known = size if size < UNKNOWN_BYTES else 0
    return max(shard_bits(rows.sparkSession), min(MOST_BITS, (2 * known // TASK_BYTES).bit_length()))


def shard_of(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits).cast("int")


def shards(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> U64(64 - bits)).astype(np.int64)


def write_sorted(rows: DataFrame, folder: str, bits: int) -> None:
    """Write rows with a ``key`` (bigint, each once) and columns of numbers as sorted shards."""
    names = [n for n in rows.columns if n != "key"]

    def write(table: pa.Table) -> pa.Table:
        columns = {n: table[n].combine_chunks().to_numpy(zero_copy_only=False) for n in ["key", *names]}
        columns["key"] = columns["key"].view(U64)
        order = np.argsort(columns["key"])
        shard = table["shard"][0].as_py()
        write_arrays(f"{folder}/{shard}", {n: c[order] for n, c in columns.items()})
        return pa.table({"n": pa.array([len(order)], pa.int64())})

    written = rows.withColumn("shard", shard_of(F.col("key"), bits)).groupBy("shard")
    written.applyInArrow(write, "n bigint").agg(F.sum("n")).collect()


def find(
    folder: str, bits: int, keys: np.ndarray, names: list[str],
    group: np.ndarray | None = None, also: dict[str, np.ndarray] | None = None,
) -> dict[str, np.ndarray]:
    """For each key whether it is stored (``found``) and its columns, 0 where it is not.

    ``group`` names the shard of each key where that is not its leading bits. ``also`` has
    further columns that must be equal, where a key may stand there more than once.
    """
    where = shards(keys, bits) if group is None else group
    order = np.lexsort((keys, where)) if group is not None else np.argsort(keys)
    sorted_keys, sorted_where = keys[order], where[order]
    out: dict[str, np.ndarray] = {"found": np.zeros(len(keys), bool)}
    begins = runs_of(sorted_where)
    files = listed(folder)
    for begin, end in zip(begins, [*begins[1:], len(keys)]):
        name = str(int(sorted_where[begin]))
        if name not in files:
            continue
        stored = read_arrays(f"{folder}/{name}")
        asked = sorted_keys[begin:end]
        if not len(stored["key"]):
            continue
        at = np.searchsorted(stored["key"], asked)
        at[at == len(stored["key"])] = 0
        hit = stored["key"][at] == asked
        rest = np.flatnonzero(hit) if also else []
        while len(rest):  # step over entries of the same key that differ
            rows = order[begin:end][rest]
            odd = np.logical_or.reduce([stored[n][at[rest]] != c[rows] for n, c in also.items()])
            rest = rest[odd]
            at[rest] += 1
            gone = at[rest] >= len(stored["key"])
            at[rest[gone]] = 0
            gone |= stored["key"][at[rest]] != asked[rest]
            hit[rest[gone]] = False
            rest = rest[~gone]
        rows = order[begin:end][hit]
        out["found"][rows] = True
        for n in names:
            if n not in out:
                out[n] = np.zeros(len(keys), stored[n].dtype)
            elif out[n].dtype != stored[n].dtype:  # shards may store numbers in fewer bytes
                out[n] = out[n].astype(np.promote_types(out[n].dtype, stored[n].dtype))
            out[n][rows] = stored[n][at[hit]]
    for n in names:
        out.setdefault(n, np.zeros(len(keys), np.int64))
    return out


def runs_of(values: np.ndarray) -> list[int]:
    if not len(values):
        return []
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))).tolist()
