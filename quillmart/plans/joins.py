"""Join helpers: broadcast a side only after checking its size.

``lookup_join`` is the star-schema join used throughout: the fact (or mart)
side is preserved, the dimension side is broadcast when it is proven small
and shuffled otherwise. The check counts a plain dimension scan up to a bound
that follows from the width of its rows (it stops after one row more); its
answer is kept for the application, the plan and the size of the files under it,
so a table that has grown is checked again. Beyond the bound, and for
aggregates, the join is a plain one, which AQE may still turn into a broadcast
at run time from real shuffle statistics, and whose skewed partitions AQE splits.

``key_lookup`` gives a fact its surrogate keys. A key follows from its id, so all that a large
dimension adds is which ids it lacks or repeats: where these are few, they are broadcast
instead, and the fact's rows stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmart.functions.keys import surrogate_key

# Bytes up to which a dimension side is broadcast, and what a value of text is taken to need.
BROADCAST_MAX_BYTES = 32 << 20
TEXT_BYTES = 96
CALENDAR_ROW = 1024
HOME = "_home"  # the column by which the rows of a fact lie: equal order ids have equal homes
ODD_IDS_MAX = 10_000  # ids that a dimension lacks or repeats, up to which they are broadcast in its place

_decisions: dict[tuple, bool] = {}
_odd: dict[tuple, list[tuple] | None] = {}


def row_bytes(schema: T.StructType) -> int:
    """A generous width of one row."""
    return 16 + sum(TEXT_BYTES if isinstance(f.dataType, (T.StringType, T.BinaryType)) else 16 for f in schema.fields)


def is_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` is proven to need at most ``max_bytes`` (a bounded scan)."""
    plan = df._jdf.queryExecution().optimizedPlan()
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), str(plan.stats().sizeInBytes()), max_bytes)
    if key not in _decisions:
        most = max_bytes // row_bytes(df.schema)
        _decisions[key] = df.limit(most + 1).count() <= most
    return _decisions[key]


def maybe_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_bytes) else df


def lookup_join(left: DataFrame, right: DataFrame, on, how: str = "left",
                max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join ``left`` to a lookup ``right`` (a dimension scan), preserving ``left`` for how='left'."""
    return left.join(maybe_broadcast(right, max_bytes), on=on, how=how)


def home_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join by ``HOME`` and ``on`` of two frames that both lie by ``HOME``: no row is moved.

    Spark deals both sides of a join out anew unless they lie by all of its keys; a window over
    their union is content with one of them. A left row repeats for each right row of its keys.
    """
    own, values = [c for c in left.columns if c not in (HOME, on)], [c for c in right.columns if c not in (HOME, on)]
    rows = left.withColumn("_right", F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType)).unionByName(
        right.where(F.col(on).isNotNull()).select(HOME, on, F.struct(*values).alias("_right")), allowMissingColumns=True)
    rows = rows.withColumn("_found", F.collect_list("_right").over(Window.partitionBy(HOME, on))).where(F.col("_right").isNull())
    return rows.select(HOME, on, *own, F.explode_outer("_found").alias("_found")).select(HOME, on, *own, "_found.*")


def near_lookup(left: DataFrame, dim: DataFrame, on: str, used: DataFrame | None = None,
                max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``lookup_join`` of a ``left`` whose rows lie by ``HOME``: they stay there.

    Where ``dim`` isn't broadcast, pairs of home and id are moved to it and come back with its columns. ``used``: a cheaper
    frame with all pairs (or more). As many rows as the plain join gives.
    """
    if HOME not in left.columns or is_broadcast(dim, max_bytes):
        return lookup_join(left, dim, on, max_bytes=max_bytes)
    held = dim.groupBy(*dim.columns).agg(F.count(F.lit(1)).cast("int").alias("_nth")).withColumn(
        "_nth", F.explode(F.sequence(F.lit(1), "_nth")))  # equal rows are told apart
    pairs = (left if used is None else used).select(HOME, on).where(F.col(on).isNotNull())
    found = pairs.join(held, on).repartition(HOME).distinct().drop("_nth")
    return home_join(left, found, on)


def is_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when a join broadcasts ``df``: by Spark's own estimate, or proven small."""
    state = df.sparkSession._jsparkSession.sessionState().conf()
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate <= state.autoBroadcastJoinThreshold() or is_small(df, max_bytes)


def odd_ids(rows: DataFrame, dim: DataFrame, on: str, most: int = ODD_IDS_MAX) -> list[tuple] | None:
    """(id, rows of ``dim``) of the ids in ``rows`` that ``dim`` doesn't hold exactly once; None if
    they make more than ``most`` rows. Only ids are moved to find out; the answer is kept as in ``is_small``."""
    used, held = rows.where(F.col(on).isNotNull()).select(on), dim.select(on)
    key = (rows.sparkSession.sparkContext.applicationId, on, most, *(
        x for df in (used, held) for x in (df.semanticHash(), str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))))
    if key not in _odd:
        n = F.coalesce("_n", F.lit(0)).cast("bigint")
        found = used.distinct().join(held.groupBy(on).agg(F.count(F.lit(1)).alias("_n")), on, "left").where(n != 1)
        odd = [tuple(r) for r in found.select(on, n).limit(most + 1).collect()]
        _odd[key] = odd if sum(max(r[1], 1) for r in odd) <= most else None
    return _odd[key]


def key_lookup(left: DataFrame, dim: DataFrame, on: str, key: str, carry: tuple[str, ...] = (),
               rows: DataFrame | None = None, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left join to the dimension ``dim`` by its id ``on``, for its surrogate key ``key`` and columns ``carry``.

    As many rows as the plain join gives: an id that ``dim`` lacks has a null key, a repeated one
    repeats the row. ``rows``: a cheaper frame that holds all ids of ``left``.
    """
    if left.schema[on].dataType != dim.schema[on].dataType:
        return lookup_join(left, dim.select(on, key, *carry), on, max_bytes=max_bytes)
    found = dim.select(on, *carry, F.lit(True).alias("_held"))
    if not is_broadcast(found, max_bytes) and not carry:
        odd = odd_ids(left if rows is None else rows, dim, on)
        if odd is not None:
            if not odd:
                return left.withColumn(key, F.when(F.col(on).isNotNull(), surrogate_key(on)))
            schema = T.StructType([T.StructField(on, dim.schema[on].dataType), T.StructField("_n", T.LongType())])
            few = left.sparkSession.createDataFrame(odd, schema).select(
                on, F.explode(F.array_repeat(F.col("_n") > 0, F.greatest("_n", F.lit(1)).cast("int"))).alias("_held"))
            known = F.col(on).isNotNull() & F.coalesce("_held", F.lit(True))
            return left.join(F.broadcast(few), on, "left").withColumn(key, F.when(known, surrogate_key(on))).drop("_held")
    joined = near_lookup(left, found, on, rows if rows is not None and HOME in rows.columns else None, max_bytes)
    return joined.withColumn(key, F.when(F.col("_held"), surrogate_key(on))).drop("_held")


def dim_column(fact: DataFrame, dim: str) -> str:
    """The column by which ``fact`` finds its rows of a dimension: the id where it holds it (a
    surrogate key is several times as wide to move), else the key."""
    return f"{dim}_id" if f"{dim}_id" in fact.columns else f"{dim}_key"


def order_key(fact: DataFrame) -> list[str]:
    """The columns by which distinct orders of ``fact`` are counted where they lie."""
    return [c for c in (HOME, "order_id") if c in fact.columns]


def calendar_join(left: DataFrame, dim_date: DataFrame, right: DataFrame, on: str,
                  max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left join to ``right``, some columns of the calendar ``dim_date``, by ``on``.

    The calendar's days are counted once, whatever columns are taken (a row is held to need at
    most ``CALENDAR_ROW`` bytes): one wrong date far off makes a long calendar, which is
    then shuffled instead of broadcast.
    """
    days = dim_date.select("date_day")
    small = is_small(days, max_bytes // CALENDAR_ROW * row_bytes(days.schema))
    return left.join(F.broadcast(right) if small else right, on=on, how="left")
