"""Skew-safe building blocks used by the operators.

Every per-group computation in this package must survive one group (a stream,
a collector, a file name) holding a third of all rows.  The helpers below
express per-group results as *partial aggregates* (map-side combine, one small
row per group and task) that are joined back, never as a window or
``collect_list`` over a whole group, and they only broadcast a side after its
size has been checked against a bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Size (bytes, Catalyst's own estimate) up to which a side is broadcast.  Topology, checkpoints and
# per-stream tables sit far below it.
BROADCAST_MAX_BYTES = 64 << 20

BROADCAST_MAX_BYTES_CONF = "minutelake.broadcast.maxBytes"


def bounded_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast ``df`` only if its estimated size is at most ``max_bytes``; runs no job.

    ``max_bytes`` defaults to the session setting ``minutelake.broadcast.maxBytes``
    (``BROADCAST_MAX_BYTES`` when unset).  The estimate is the optimized plan's: exact for
    inline tables, file sizes for tables on disk, and an upper bound (products of sizes for
    joins, "unknown" = huge for frames built from RDDs) for anything derived.  Above the
    bound the frame is returned unhinted: the join is a shuffle join that AQE turns into a
    broadcast when the materialised side is small.
    """
    if max_bytes is None:
        max_bytes = int(df.sparkSession.conf.get(BROADCAST_MAX_BYTES_CONF, str(BROADCAST_MAX_BYTES)))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= max_bytes else df


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A configuration table as an inline relation, whose size Catalyst knows."""
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    if not rows:
        return spark.createDataFrame([], schema)
    casts = [F.expr(f"cast({n} AS {k})") for n, k in (x.strip().split(" ") for x in schema.split(","))]
    values = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})").select(*casts)


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def join_group_values(df: DataFrame, groups: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join per-group aggregates back onto ``df`` on ``keys``.

    No static hint: the aggregate's size is only known at runtime, and counting it
    first would compute its whole input twice.  AQE materialises the aggregate as
    a shuffle stage, checks its actual size and turns the join into a broadcast
    hash join under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above it the
    shuffle join stays and AQE's skew handling splits a hot key's partition.
    """
    return df.join(groups, keys, how)


def latest_per_group(df: DataFrame, keys: list[str], order: list[str], take: list[str]) -> DataFrame:
    """Row with the greatest ``order`` tuple per group, via ``max(struct)``.

    Equivalent to ``row_number() over (partition by keys order by order desc) = 1``
    but computed as a partial aggregate, so a hot group is combined map-side.
    """
    st = F.struct(*[F.col(o) for o in order], *[F.col(t).alias(f"__t_{t}") for t in take])
    out = df.groupBy(*keys).agg(F.max(st).alias("__m"))
    return out.select(*keys, *[F.col(f"__m.__t_{t}").alias(t) for t in take])


def kth_largest(df: DataFrame, keys: list[str], col: str, k: int, alias: str,
                salts: int = 32) -> DataFrame:
    """The k-th largest distinct-or-not value of ``col`` per group (null if < k rows).

    Two stages: rank inside ``(keys, salt)`` buckets and keep the top ``k`` of each
    bucket, then take the k-th of the per-group candidate list, which holds at most
    ``k * salts`` values.  Exact, because the global top ``k`` is contained in the
    union of the per-bucket top ``k``.  Ties between equal values count separately,
    matching a ``row_number`` over the group.
    """
    salt = F.abs(F.xxhash64(*[F.col(x) for x in df.columns])) % salts
    staged = df.select(*keys, col).withColumn("__salt", salt)
    w1 = Window.partitionBy(*keys, "__salt").orderBy(F.col(col).desc())
    cand = staged.withColumn("__r", F.row_number().over(w1)).filter(F.col("__r") <= k).drop("__r", "__salt")
    # second stage: at most k * salts candidates per group, so their sorted list is bounded
    top = cand.groupBy(*keys).agg(F.sort_array(F.collect_list(col), asc=False).alias("__c"))
    return top.filter(F.size("__c") >= k).select(*keys, F.element_at("__c", k).alias(alias))


def next_in_order(df: DataFrame, keys: list[str], order_col: str, carry: list[str],
                  bucket: Column, prefix: str = "next_") -> DataFrame:
    """``lead(order_col, carry...)`` per group without a whole-group window task.

    Rows are windowed inside ``(keys, bucket)`` (for minutes: the day), which bounds
    each window task by the bucket width.  The last row of a bucket takes its
    successor from the first row of the next non-empty bucket of the same group,
    found on the per-bucket summary (one row per group and bucket, small).
    ``order_col`` must be unique within a group.
    """
    names = [order_col] + carry
    # one exchange by (group, bucket) feeds the window, the bucket summary and the join back
    b = df.withColumn("__b", bucket).repartition(*keys, "__b")
    w = Window.partitionBy(*keys, "__b").orderBy(order_col)
    rows = b
    for n in names:
        rows = rows.withColumn(f"{prefix}{n}", F.lead(n).over(w))
    first = F.min(F.struct(F.col(order_col).alias("__o"), *[F.col(n).alias(f"__c_{n}") for n in carry]))
    firsts = b.groupBy(*keys, "__b").agg(first.alias("__first"))
    ws = Window.partitionBy(*keys).orderBy("__b")
    summary = firsts.select(*keys, "__b", F.lead("__first").over(ws).alias("__succ"))
    rows = join_group_values(rows, summary, keys + ["__b"])
    fill = [F.coalesce(F.col(f"{prefix}{order_col}"), F.col("__succ.__o")).alias(f"{prefix}{order_col}")]
    for n in carry:
        fill.append(F.when(F.col(f"{prefix}{order_col}").isNotNull(), F.col(f"{prefix}{n}"))
                    .otherwise(F.col(f"__succ.__c_{n}")).alias(f"{prefix}{n}"))
    others = [x for x in rows.columns if x not in {"__b", "__succ"} and x not in {f"{prefix}{n}" for n in names}]
    return rows.select(*others, *fill)
