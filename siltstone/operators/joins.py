"""Joining facts to dimensions whose size and key skew are not known beforehand."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkAttributeError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The session's threshold is meant for file sizes; the rows of such files take several
# times the space, and rows are what is measured here.
_ROWS_PER_FILE_BYTE = 8

_SALT = "__salt"

# Keys that a sketch follows per partition, and at most; the latter is Spark's own limit.
_TRACKED_PER_PARTITION, _TRACKED_MOST = 16, 1_000_000

_BYTE_UNITS = {"": 1, "b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30}


def broadcast_limit(df: DataFrame) -> int:
    """Largest size of broadcast rows: 80 MB by default, negative if broadcasting is off.

    Follows ``spark.sql.autoBroadcastJoinThreshold`` of the session.
    """
    setting = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", setting).groups()
    return int(number) * _BYTE_UNITS[unit.lower()] * _ROWS_PER_FILE_BYTE


def _row_bytes(df: DataFrame) -> Column | None:
    """Space a row takes in Spark's row format, rounded up; None for nested columns.

    A header, a word and a length per field, and the bytes of texts and binaries.
    """
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    if any(isinstance(f.dataType, nested) for f in df.schema):
        return None
    variable = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    lengths = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in variable]
    fixed = F.lit(16 + 16 * len(df.columns)).cast("long")
    return reduce(lambda a, b: a + b, lengths, fixed)


def measured_bytes(frames: Sequence[DataFrame]) -> list[int]:
    """Total row bytes of each frame, from one job; a task sends one number."""
    totals = [
        df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes")).select(F.lit(n).alias("n"), "bytes")
        for n, df in enumerate(frames)
    ]
    found = dict(tuple(row) for row in reduce(DataFrame.unionAll, totals).collect())
    return [found[n] for n in range(len(totals))]


def _input_bytes(df: DataFrame) -> int | None:
    """The optimizer's size of everything the frame reads: file sizes, before decompression."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except PySparkAttributeError:  # remote sessions expose no plan
        return None
    leaves = plan.collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def fits_broadcast(frames: Sequence[DataFrame]) -> list[bool]:
    """Whether each frame's rows are proven to be below the broadcast limit.

    File sizes prove nothing, as a small file can hold many equal rows, so
    frames are measured. They do say whether measuring is worth its cost: large
    inputs are taken to be too large without a look.
    """
    fits = [False] * len(frames)
    limit = broadcast_limit(frames[0]) if frames else -1
    if limit < 0:
        return fits
    inputs = [_input_bytes(df) for df in frames]
    worth = [
        n
        for n, (df, size) in enumerate(zip(frames, inputs))
        if size is not None and size <= limit and _row_bytes(df) is not None
    ]
    if worth:
        for n, size in zip(worth, measured_bytes([frames[n] for n in worth])):
            fits[n] = size <= limit
    return fits


def _key_hash(df: DataFrame, keys: list[str]) -> Column:
    """Integers of any width hash as longs, so that equal keys hash alike."""
    return F.xxhash64(
        *(
            F.col(k).cast("long") if isinstance(df.schema[k].dataType, T.IntegralType) else F.col(k)
            for k in keys
        )
    )


def _hash_alike(fact: DataFrame, dim: DataFrame, keys: Mapping[str, str]) -> bool:
    """Whether equal keys have equal hashes: same type, or both integers."""
    pairs = [(fact.schema[f].dataType, dim.schema[d].dataType) for f, d in keys.items()]
    return all(
        left == right or (isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType))
        for left, right in pairs
    )


def hot_key_hashes(df: DataFrame, keys: list[str], fan_out: int) -> Column:
    """Scalar subquery: hashes of all keys that outweigh an average one of ``fan_out`` partitions.

    Reads the key columns only. Every task keeps a frequent-items sketch of bounded size, which is all that is shuffled, and
    no key that heavy falls out of it. Counts are at most a sixth of that average too high where keys are many, so that a few
    lighter ones may be listed, and exact where they are few. Fewer than ``fan_out`` can be heavy, which bounds the list.
    """
    tracked = min(_TRACKED_MOST, _TRACKED_PER_PARTITION * fan_out)
    listed = min(2 * fan_out, tracked)
    found = df.select(_key_hash(df, keys).alias("h")).agg(
        F.call_function("approx_top_k", F.col("h"), F.lit(listed), F.lit(tracked)).alias("top"), F.count("*").alias("n")
    )
    listed_keys = found.select(F.explode("top").alias("key"), "n")
    heavy = listed_keys.where(F.col("key.count") > F.col("n") / F.lit(fan_out))
    return heavy.agg(F.collect_list("key.item").alias("hot")).scalar()


def _salted(
    fact: DataFrame,
    dim: DataFrame,
    keys: list[str],
    dim_keys: list[str],
    key_rows: DataFrame,
    null_safe: bool,
) -> tuple[DataFrame, DataFrame]:
    """Give each hot fact key ``fan_out`` salts, and its dimension row one copy per salt.

    The salt is the map partition's number: it needs no further column, it is
    the same when a lost task runs again, and equal copies of a row in
    different input splits still part ways. Rows with a NULL key match
    nothing, so they are spread too, unless NULL is a key like any other.
    """
    fan_out = max(2, int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = hot_key_hashes(key_rows, keys, fan_out)
    nulls = [] if null_safe else [F.col(k).isNull() for k in keys]
    spread = F.pmod(F.spark_partition_id(), F.lit(fan_out))
    is_hot = F.array_contains(hot, _key_hash(fact, keys))
    apart = reduce(lambda a, b: a | b, nulls, is_hot)
    fact = fact.withColumn(_SALT, F.when(apart, spread).otherwise(F.lit(0)))
    all_salts = F.sequence(F.lit(0), F.lit(fan_out - 1))
    one_salt = F.array(F.lit(0))
    dim_hot = F.array_contains(hot, _key_hash(dim, dim_keys))
    copies = F.explode(F.when(dim_hot, all_salts).otherwise(one_salt))
    return fact, dim.withColumn(f"{_SALT}_dim", copies)


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    keys: Mapping[str, str],
    how: str = "left",
    key_rows: DataFrame | None = None,
    null_safe: bool = False,
    fits: bool | None = None,
) -> DataFrame:
    """Equi-join ``fact`` to ``dim`` on ``{fact column: dim column}``.

    ``how`` is left, inner, left_semi or left_anti. Left and inner expect one
    dimension row per key. The dimension's own key columns are not returned;
    fact columns keep their order and dimension attributes follow.

    A dimension measured to be below the broadcast limit is broadcast. A larger
    one is shuffled, with keys too heavy for one partition salted. Heavy keys are
    looked for in ``key_rows``, by default the fact itself; a frame with the
    same key columns that is cheaper to read does as well, since the answer
    only decides where rows are processed. ``null_safe`` lets NULL equal NULL.
    ``fits`` is the outcome of ``fits_broadcast`` if the caller has it already.

    Keys of unequal types, such as text and numbers, compare as Spark casts
    them; they are not salted, which leaves skew to adaptive execution.
    """
    hash_alike = _hash_alike(fact, dim, keys)
    fact_keys, renamed = list(keys), {d: f"__dim_{d}" for d in keys.values()}
    clash = sorted(set(fact.columns) & (set(dim.columns) - set(renamed)))
    if clash and how in ("left", "inner"):
        raise ValueError(f"Columns present on both sides: {clash}")
    dim_keys = [renamed[d] for d in keys.values()]
    if how in ("left_semi", "left_anti"):
        dim = dim.select(*renamed)
    dim = dim.withColumnsRenamed(renamed)

    pairs = []
    if fits_broadcast([dim])[0] if fits is None else fits:
        left, right = fact, F.broadcast(dim)
    elif not hash_alike:
        left, right = fact, dim
    else:
        if how in ("inner", "left_semi") and not null_safe:
            fact = fact.dropna(subset=fact_keys)
        key_rows = fact if key_rows is None else key_rows
        left, right = _salted(fact, dim, fact_keys, dim_keys, key_rows, null_safe)
        pairs = [left[_SALT] == right[f"{_SALT}_dim"]]
    for f, d in zip(fact_keys, dim_keys):
        pairs.append(left[f].eqNullSafe(right[d]) if null_safe else left[f] == right[d])
    condition = reduce(lambda a, b: a & b, pairs)
    return left.join(right, condition, how).drop(_SALT, f"{_SALT}_dim", *dim_keys)


def orphans(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str | None = None,
    key_rows: DataFrame | None = None,
) -> DataFrame:
    """Fact rows whose key is unknown to the dimension; a NULL key is unknown."""
    return join_dimension(fact, dim, {fact_key: dim_key or fact_key}, "left_anti", key_rows)


def known_rows(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str | None = None,
    key_rows: DataFrame | None = None,
) -> DataFrame:
    """Fact rows whose key is known; a dimension with repeated keys adds no rows."""
    return join_dimension(fact, dim, {fact_key: dim_key or fact_key}, "left_semi", key_rows)


def null_safe_match(left: DataFrame, right: DataFrame, keys: Mapping[str, str]) -> Column:
    """All keys equal, NULL equal to NULL."""
    return reduce(lambda a, b: a & b, (left[l].eqNullSafe(right[r]) for l, r in keys.items()))
