"""Order-dependent computations that stay parallel when one key is hot.

A window ``partitionBy(key).orderBy(seq)`` puts every row of a key into one task.
When a single key (an offering, a student, a whole table with no key) may hold a
third of all rows, that task is the job. Running sums therefore count the rows of each key
first: keys of at most ``HOT_ROWS`` rows are one plain window, dealt by key. The rows of larger
ones (and of a whole table) are dealt by range of
(key, order) into partitions of about equal row counts, so a hot key spans many of
them whatever its order values are; aggregated once per (key, partition); those
totals are carried forward over a table with at most one row per key and partition; and finished
inside each (key, partition). No task sees more than one partition's rows of a key.

Orderings must be unique within a key (ties would make "earlier" ambiguous).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrar.session import scratch_path

_CHUNK = "__chunk"
_KEY = "__key"


#: Rows of a key that one task may order.
HOT_ROWS = 1 << 18
#: Hash classes of keys that are counted first, in the scan; only a class of more rows is looked at by key.
CLASSES = 1 << 14


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder as parquet and return it with its
    lineage cut. Used wherever a result is read by several branches of a plan: the helpers below read
    their input twice (per-key or per-chunk totals and the rows themselves), so without this
    every helper would double the whole upstream lineage and stacked helpers would
    multiply it. Parquet keeps columns apart and packed, and its size is known to the joins
    above; a reliable ``checkpoint`` writes every row as an object."""
    spark = df.sparkSession
    path = scratch_path(spark, "kept")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _dealt(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], parts: int | None) -> DataFrame:
    """The rows dealt by range of (keys, order) into ``parts`` partitions (as many as the
    session shuffles into by default), with the partition's number; materialized, since
    the helpers read them twice and the numbers must not change in between."""
    n = parts or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return materialize(df.repartitionByRange(n, *keys, *order_cols).withColumn(_CHUNK, F.spark_partition_id()))


def _key(keys: Sequence[str], chunk_cols: Sequence[str]):
    """One struct column for (keys, chunk): struct equality matches null fields, so
    rows with a null key still find their chunk; and the join and the row window
    below share this single partitioning column, so no second shuffle."""
    return F.struct(*[F.col(c) for c in [*keys, *chunk_cols]])


def running_sums(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                 values: dict[str, Column | str], inclusive: bool = False, parts: int | None = None,
                 stored: bool = False) -> DataFrame:
    """Add one column per ``values`` entry (out name -> value): the sum of the value
    over earlier rows of the same key (and this row when ``inclusive``), in
    ``order_cols`` order. ``keys`` may be empty (whole table). ``parts``: deal all rows by range
    into so many partitions. ``stored``: ``df`` is cheap to read twice and the same each time.

    Equal to ``sum(v) over (partition by keys order by order_cols rows between
    unbounded preceding and 1 preceding)`` for every v.
    """
    keys = list(keys)
    vals = {f"__v{i}": (F.col(v) if isinstance(v, str) else v) for i, v in enumerate(values.values())}
    outs = dict(zip(vals, values))
    d = df
    for name, v in vals.items():
        d = d.withColumn(name, F.coalesce(v.cast("long"), F.lit(0)))
    upper = Window.currentRow if inclusive else -1
    if parts or not keys:
        return _sums_by_chunk(d, keys, order_cols, outs, upper, parts)
    d = d if stored else materialize(d)
    hot = _hot_keys(d, keys)
    if hot is None:
        return _sums_by_key(d, keys, order_cols, outs, upper)
    keyed = d.withColumn(_KEY, _key(keys, []))  # null keys find their like
    cold = _sums_by_key(keyed.join(hot, _KEY, "left_anti").drop(_KEY), keys, order_cols, outs, upper)
    return cold.unionByName(_sums_by_chunk(keyed.join(hot, _KEY, "left_semi").drop(_KEY), keys, order_cols, outs, upper, parts))


def _hot_keys(d: DataFrame, keys: list[str]) -> DataFrame | None:
    """The keys of more than ``HOT_ROWS`` rows, None without any. A key has no more rows than its
    hash class, and the classes' counts leave the scan as a row a class, so rows are dealt by key for
    the classes above the limit only."""
    of = F.pmod(F.xxhash64(*keys), F.lit(CLASSES))
    full = materialize(d.groupBy(of.alias("__c")).agg(F.count("*").alias("__n")).where(F.col("__n") > HOT_ROWS).select("__c"))
    if full.isEmpty():
        return None
    rows = d.withColumn("__c", of).join(full, "__c", "left_semi")
    hot = materialize(rows.groupBy(_key(keys, []).alias(_KEY)).agg(F.count("*").alias("__n")).where(F.col("__n") > HOT_ROWS).select(_KEY))
    return None if hot.isEmpty() else hot


def _sums_by_key(d: DataFrame, keys: list[str], order_cols: Sequence[str], outs: dict[str, str], upper: int) -> DataFrame:
    """A window per key, for keys of bounded size."""
    w = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, upper)
    for n, out in outs.items():
        d = d.withColumn(out, F.coalesce(F.sum(n).over(w), F.lit(0)))
    return d.drop(*outs)


def _sums_by_chunk(d: DataFrame, keys: list[str], order_cols: Sequence[str], outs: dict[str, str], upper: int, parts: int | None) -> DataFrame:
    """Two levels: per-chunk totals carried forward, then a window inside each chunk, in one
    aggregation, one small window, one join and one row window for all values."""
    d, chunk_cols = _dealt(d, keys, order_cols, parts), [_CHUNK]
    totals = d.groupBy(*keys, *chunk_cols).agg(*[F.sum(n).alias(f"{n}_t") for n in outs])
    w_chunks = Window.partitionBy(*keys).orderBy(*chunk_cols).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_key(keys, chunk_cols).alias(_KEY),
                            *[F.coalesce(F.sum(f"{n}_t").over(w_chunks), F.lit(0)).alias(f"{n}_o") for n in outs])
    d = d.withColumn(_KEY, _key(keys, chunk_cols)).join(offsets, _KEY)
    w_rows = Window.partitionBy(_KEY).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, upper)
    for n, out in outs.items():
        d = d.withColumn(out, F.col(f"{n}_o") + F.coalesce(F.sum(n).over(w_rows), F.lit(0)))
    return d.drop(*outs, *[f"{n}_o" for n in outs], _CHUNK, _KEY)


def running_sum(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value: Column | str,
                out: str, inclusive: bool = False, parts: int | None = None, stored: bool = False) -> DataFrame:
    """Add ``out`` = sum of ``value`` over earlier rows of the same key (see running_sums)."""
    return running_sums(df, keys, order_cols, {out: value}, inclusive, parts, stored)


def running_count(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], flag: Column | str,
                  out: str, inclusive: bool = False, parts: int | None = None, stored: bool = False) -> DataFrame:
    """Number of earlier rows of the same key where ``flag`` holds (see running_sum)."""
    f = F.col(flag) if isinstance(flag, str) else flag
    return running_sum(df, keys, order_cols, F.when(f, F.lit(1)).otherwise(F.lit(0)), out, inclusive, parts, stored)


def previous_value(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value: str,
                   out: str, default: Column | None = None, parts: int | None = None) -> DataFrame:
    """Add ``out`` = ``value`` of the previous row of the same key (``lag(value, 1)``),
    or ``default`` for the first row of a key; split by chunks like running_sum."""
    keys = list(keys)
    d, chunk_cols = _dealt(df, keys, order_cols, parts), [_CHUNK]
    order_struct = F.struct(*[F.col(c) for c in order_cols])
    last = d.groupBy(*keys, *chunk_cols).agg(F.max_by(F.col(value), order_struct).alias("__last"))
    w_chunks = Window.partitionBy(*keys).orderBy(*chunk_cols)
    carry = last.select(_key(keys, chunk_cols).alias(_KEY), F.lag("__last", 1).over(w_chunks).alias("__carry"),
                        F.row_number().over(w_chunks).alias("__cn"))
    d = d.withColumn(_KEY, _key(keys, chunk_cols)).join(carry, _KEY)
    w_rows = Window.partitionBy(_KEY).orderBy(*order_cols)
    first_of_key = (F.col("__cn") == 1) & (F.row_number().over(w_rows) == 1)
    prev = F.when(F.row_number().over(w_rows) == 1, F.col("__carry")).otherwise(F.lag(value, 1).over(w_rows))
    if default is not None:
        prev = F.when(first_of_key, default).otherwise(prev)
    return d.withColumn(out, prev).drop("__carry", "__cn", _CHUNK, _KEY)


def dense_ids(df: DataFrame, order_cols: Sequence[str], out: str, start: Column | int = 0,
              parts: int | None = None) -> DataFrame:
    """Number the rows 1..n in ``order_cols`` order and add ``start``: ids for new rows
    (like a SERIAL counter) without a single-task global ``row_number`` — the only
    global step runs over one total per chunk."""
    numbered = running_count(df, [], order_cols, F.lit(True), "__k", inclusive=True, parts=parts)
    s = start if isinstance(start, Column) else F.lit(start)
    return numbered.withColumn(out, (s + F.col("__k")).cast("long")).drop("__k")
