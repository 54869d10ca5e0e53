"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def workers_import(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, if that path is theirs
    too (local mode, a shared or baked-in folder). Elsewhere the package is shipped with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names built from ``names`` that do not clash with ``df``'s own."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def no_clash(df: DataFrame, *names: str) -> None:
    """Raises if ``df`` has a column named like one that is to be added."""
    taken = {n.lower() for n in names} & {c.lower() for c in df.columns}
    if taken:
        raise ValueError(f"the input already has {', '.join(sorted(taken))}: rename it, or name the output differently")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/veilspark-llm/{uuid.uuid4().hex}/{name}"


#: paths of the tables that ``stored`` has written, for ``released``
_written: list[str] = []


@contextmanager
def released(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes, on leaving, the tables that were stored inside, but for the paths that the body adds to the list
    (what is still to be read)."""
    first, keep = len(_written), []
    yield keep
    for path in set(_written[first:]) - set(keep):
        drop_stored(spark, path)
    _written[first:] = keep


def drop_stored(spark: SparkSession, path: str) -> None:
    """Deletes a table that ``stored`` has written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent()  # of this table alone
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def last_stored() -> str:
    """The path of the table that was stored last."""
    return _written[-1]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read back.

    Cuts the lineage and survives lost executors. Spark then knows the table's
    size, so a join with it is broadcast only if it is under the session's own
    ``autoBroadcastJoinThreshold``, and shuffled otherwise.
    """
    path = shared_path(df.sparkSession, name)
    _written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: hashes of keys that the bitmaps of ``may_be_among`` tell apart
BITS = 1 << 25


def may_be_among(rows: DataFrame, columns: list[str], keys: DataFrame, key_columns: list[str], maybe: str = "maybe",
                 bits: int = BITS) -> DataFrame:
    """``rows`` with ``maybe``: true for all whose ``columns`` are a row of ``keys`` (columns of the same types; nulls are
    equal) and, by a hash, for a few others; false for the rest, which so need not be shuffled to a join with ``keys``.

    The hashes of the keys set bits in bitmaps that are broadcast: ``bits`` / 8 bytes at most, however many the keys
    are. With far more keys than bits every row may be among them, and the join shuffles all rows, as it would anyway.
    """
    bucket, bitmap = fresh(rows, "bucket_", "bitmap_")
    place = lambda names: F.pmod(F.xxhash64(*names), F.lit(bits)) + 1
    bitmaps = keys.groupBy(F.bitmap_bucket_number(place(key_columns)).alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place(key_columns))).alias(bitmap))
    at = F.bitmap_bit_position(place(columns))
    byte = F.conv(F.hex(F.col(bitmap).substr((F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return rows.join(F.broadcast(bitmaps), F.bitmap_bucket_number(place(columns)) == F.col(bucket), "left").withColumn(
        maybe, hit).drop(bucket, bitmap)


def whole_text(column: str = "text"):
    """The text column with null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_mod(column: str, n: int):
    """crc32 of the id written as text, modulo ``n``; a null id counts as the empty string."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(n))
