"""Joins and groupings that keep their balance when one key dominates.

Two things put a large share of all rows on one task of a keyed shuffle: null
keys, which an outer join may never match but still has to emit, and values
that many rows share.  Both are spread here over all shuffle partitions by a
*salt*, a small number that joins the key.  Which keys are heavy comes from a
frequent-items sketch over the key columns alone; it only steers the layout, so
results never depend on it.

Salts are functions of row content and map partition.  A retried task
recomputes the same ones, so a lost executor cannot lose or repeat rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType, ArrayType

from sluicework.operators.schema import column

# A shuffle below this planned size fits one task even if it has only one key.
SPLIT_ABOVE_BYTES = 256 * 1024 * 1024
# At most this many keys are salted, so what is broadcast stays this small; no
# more keys than this can have the least share that counts as heavy.
MAX_HEAVY_KEYS = 2_000
LEAST_HEAVY_SHARE = 1 / MAX_HEAVY_KEYS
# A key is heavy if it fills this many average shuffle partitions.
_HEAVY_PARTITIONS = 2
# Salts per average shuffle partition: more even out how salts fall to tasks.
_SALTS_PER_PARTITION = 4
_SKETCH_ITEMS = 10_000

SALT = "__salt"
HASH = "__hash"
SALTS = "__salts"


def key_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def planned_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan; None where it is out of reach."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
    except AttributeError:
        return None
    return int(str(stats.sizeInBytes()))


def is_large(df: DataFrame, above: int | None = None) -> bool:
    size = planned_bytes(df)
    return size is None or size > (SPLIT_ABOVE_BYTES if above is None else above)


def is_broadcastable(df: DataFrame) -> bool:
    """Whether Catalyst would broadcast this side by its own threshold."""
    size = planned_bytes(df)
    return size is not None and size <= bytes_conf(
        df.sparkSession, "spark.sql.autoBroadcastJoinThreshold"
    )


def bytes_conf(spark: SparkSession, name: str) -> int:
    text = spark.conf.get(name).strip().lower().rstrip("b")
    scale = {"k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}.get(text[-1:], 1)
    return int(text if scale == 1 else text[:-1]) * scale


def fan_out(spark: SparkSession) -> int:
    """How many tasks a shuffle has to spread rows over."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def is_orderable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return is_orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(is_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, MapType)


def row_salt(df: DataFrame, salts: Column | int) -> Column:
    """A salt that spreads distinct rows by content and equal rows by map task."""
    content = [column(f.name) for f in df.schema.fields if is_orderable(f.dataType)]
    digest = F.xxhash64(*content, F.spark_partition_id()) if content else F.spark_partition_id()
    return F.pmod(digest, F.lit(salts).cast("bigint")).cast("int")


def any_null(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [column(k).isNull() for k in keys])


def key_hash(keys: Sequence[str], kinds: Sequence[DataType]) -> Column:
    return F.xxhash64(*[column(k).cast(kind) for k, kind in zip(keys, kinds)])


def heavy_hashes(df: DataFrame, digest: Column) -> DataFrame:
    """Hashes of heavy keys, at most ``MAX_HEAVY_KEYS``, and the salts each should have.

    One scan of the key columns folds every row into a mergeable sketch of fixed
    size.  Whatever else shares a hash is treated as heavy too.  Salts follow the
    rows of a key, so all keys together have a few per shuffle partition.
    """
    tasks = fan_out(df.sparkSession)
    sketch = df.select(digest.alias(HASH)).agg(
        F.expr(f"approx_top_k({HASH}, {MAX_HEAVY_KEYS}, {_SKETCH_ITEMS})").alias("top"),
        F.count(F.lit(1)).alias("rows"),
    )
    share = F.col("count") / F.col("rows")
    return (
        sketch.select("rows", F.inline("top"))
        .where(share >= max(_HEAVY_PARTITIONS / tasks, LEAST_HEAVY_SHARE))
        .select(
            F.col("item").alias(HASH),
            F.ceil(share * tasks * _SALTS_PER_PARTITION).cast("int").alias(SALTS),
        )
    )


def common_kinds(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[DataType]:
    both = left.select(*map(column, keys)).unionAll(right.select(*map(column, keys)))
    return [f.dataType for f in both.schema.fields]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str],
    how: str,
    split_above: int | None = None,
) -> DataFrame:
    """Join ``left`` to a ``right`` that has few rows per key.

    ``how`` is ``left``, ``left_semi`` or ``left_anti``; null keys match nothing.
    If the join will shuffle a large left side, rows with null or heavy keys get
    a salt, and the right rows of heavy keys are repeated once per salt.
    """
    keys = key_list(keys)
    right = right.where(~any_null(keys))
    if is_broadcastable(right) or not is_large(left, split_above):
        return left.join(right, keys, how)
    digest = key_hash(keys, common_kinds(left, right, keys))
    heavy = heavy_hashes(left.where(~any_null(keys)), digest)
    salts = (
        F.when(any_null(keys), F.lit(fan_out(left.sparkSession)))
        .when(F.col(SALTS).isNotNull(), F.col(SALTS))
        .otherwise(F.lit(1))
    )
    spread = F.when(salts > 1, row_salt(left, salts)).otherwise(F.lit(0))
    repeated = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1))

    def marked(df: DataFrame, salt: Column) -> DataFrame:
        hashed = df.withColumn(HASH, digest).join(F.broadcast(heavy), HASH, "left")
        return hashed.withColumn(SALT, salt).drop(HASH, SALTS)

    return marked(left, spread).join(marked(right, repeated), [*keys, SALT], how).drop(SALT)
