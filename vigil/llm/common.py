"""Helpers shared by the operators of this package."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import importable, shared_dir

WHITE = " \t\n\x0b\x0c\r"              # [\x20\x09-\x0D]
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """A-Z to lower case, every other character unchanged."""
    return F.translate(col, _UPPER, _UPPER.lower())


def strip_white(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITE))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there and a lost executor costs no recomputation of what came before."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def low_hash(hexadecimal: Column, share: float) -> Column:
    """Whether a digest in hexadecimal is among the lowest ``share`` of all."""
    return F.substring(hexadecimal, 1, 8) < F.lit(f"{int(share * 16 ** 8):08x}") if share < 1 else F.lit(True)


def id_crc32(col: Column) -> Column:
    """crc32 of the id written as text (null for a null id)."""
    return F.crc32(col.cast("string").cast("binary"))


def fixed_width(arr: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The bytes of a binary column whose values all have ``width`` bytes, as
    a (rows, width) array."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if len(arr) == 0:
        return np.zeros((0, width), np.uint8)
    if pa.types.is_large_binary(arr.type):
        arr = arr.cast(pa.binary())
    offsets = np.frombuffer(arr.buffers()[1], np.int32)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], np.uint8)
    return data[offsets[0]:offsets[-1]].reshape(len(arr), width)


def finite_rows(lists: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and components (doubles) of the lists that hold ``dim``
    numbers, none of them null or non-finite."""
    length = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(np.maximum(length, 0)) - np.maximum(length, 0)
    flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)     # null becomes NaN
    rows = np.flatnonzero(length == dim)
    x = flat[start[rows][:, None] + np.arange(dim)] if len(rows) else np.zeros((0, dim))
    fine = np.isfinite(x).all(1)
    return rows[fine], x[fine]


_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


def seeded64(x: np.ndarray, seed: int) -> np.ndarray:
    """``x`` hashed with a seed."""
    with np.errstate(over="ignore"):
        return mix64(x + _C1 * np.uint64(seed + 1))
