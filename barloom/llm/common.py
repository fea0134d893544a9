"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SALTS = 128  # groups that the rows of one key are dealt over in salted_lookup


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and go on from
    there: the work before it runs once, and survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like ``saved``, as a Parquet table in the shared folder: smaller than a
    checkpoint, and readers take the columns they need."""
    spark = df.sparkSession
    path = joined_path(ensure_checkpoint_dir(spark), f"table-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder as a path that every executor has mounted.
    Memory-mapped files need one; other stores raise."""
    url = urlparse(ensure_checkpoint_dir(spark))
    if url.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {url.geturl()}")
    return url.path


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]],
                schema: str) -> DataFrame:
    """``mapInArrow`` for functions that yield dicts of column lists."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for cols in work(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[f.name], type=f.type, from_pandas=False) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def slices(batches: Iterator[pa.RecordBatch], chars: int = 4_000_000) -> Iterator[tuple]:
    """Rows of the batches as lists of columns, cut so that one slice holds
    about ``chars`` bytes (a longer text is a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        per_row = max(1, batch.nbytes // batch.num_rows)
        step = max(1, chars // per_row)
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield tuple(part.column(i).to_pylist() for i in range(part.num_columns))


def training_row(doc_id: str = "doc_id") -> Column:
    """Rows labels may be learnt from: crc32 of the id as text, mod 5, not 0.
    A null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 != 0


def hash_sample(df: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """A repeatable sample of about ``rows`` rows, chosen by a hash of the
    key; everything when there are fewer."""
    n = df.count()
    if n <= rows:
        return df
    share = int((1 << 30) * rows / n)
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) < share).limit(2 * rows)


def fits(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows (reads no more than that)."""
    return df.limit(limit + 1).count() <= limit


def with_salt(df: DataFrame, salts: int = SALTS) -> DataFrame:
    """``df`` with a group number by position, for ``salted_lookup``.  Store
    the result: the numbers must not change between two readings."""
    return df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))


def salted_lookup(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows of ``with_salt``, left-joined to ``table``, which has at
    most one row for each key (nulls are equal).  The rows of one key are
    spread over its salts and only the (key, salt) pairs that occur are looked
    up, so a hot key is spread and nothing is multiplied."""
    pairs = rows.select(*keys, "_salt").distinct()
    named = table.withColumnsRenamed({k: f"_t_{k}" for k in keys})
    found = pairs.join(named, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]).drop(*[f"_t_{k}" for k in keys])
    found = found.withColumnsRenamed({k: f"_f_{k}" for k in [*keys, "_salt"]})
    same = [F.col(k).eqNullSafe(F.col(f"_f_{k}")) for k in [*keys, "_salt"]]
    return rows.join(found, same, "left").drop("_salt", *[f"_f_{k}" for k in [*keys, "_salt"]])


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def hex64(col: Column) -> Column:
    return F.lpad(F.lower(F.hex(col)), 16, "0")


def joined_path(*parts: str) -> str:
    return os.path.join(*parts)
