"""As-of join: for each probe row the latest earlier event of its key, with the event's columns.

Spark has no as-of join.  A join on the key pairs every probe with every event,
and a window over the key sorts a hot key in one task.  Here probes and
events are sorted together by range partitioning on (key, time), so that a
hot key spreads over as many parts as its rows need:

1. Within a part, the last event before each probe is a window over the part's
   own rows of the key.
2. A key that runs over several parts is the first or last key of one of
   them, so there are at most two such keys a part.  The last event of each of their
   parts is handed to the parts that follow; this table, the only one that is
   broadcast, has at most two rows for each part.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import checkpoint_root, delete_folder

_PART = "__part"
_EVENT = "__event"
_TIME = "__time"
_RANK = "__rank"
_ROW = "__row"
_SEEN = "__seen"


def _key(i: int) -> str:
    return f"__key{i}"


def latest_before(probes: DataFrame, events: DataFrame, by: list[str], time: str, tie: str,
                  carry: dict[str, str], within: Column | None = None, parts: int | None = None,
                  stored: list[str] | None = None) -> DataFrame:
    """Every row of ``probes`` with columns of the latest event of its key that is strictly earlier.

    ``by`` and ``time`` are columns of both sides; of events with equal keys
    and times the one with the smallest ``tie``, a whole number, counts (nulls last), and one of rows
    equal in all of these.  ``carry`` maps columns of ``events`` to their output
    names.  ``within`` is a condition on the probe's columns and the output
    names; where it doesn't hold, nothing is found.  What isn't found is
    null, as it is for probes with a null key or time; events with a null
    key or time are never found.

    The sorted rows are written to the shared checkpoint folder, in ``parts``
    parts (by default the session's shuffle partitions).  The folder must live as
    long as the result is read: ``stored``, if given, gets its path, to be
    removed with ``session.delete_folder``.
    """
    spark = probes.sparkSession
    whole = [*by, time]
    asked = reduce(and_, [F.col(c).isNotNull() for c in whole])
    keys = [_key(i) for i in range(len(by))]
    keyed = [F.col(c).alias(k) for c, k in zip(by, keys)]
    out = {name: events.schema[c].dataType for c, name in carry.items()}

    # one of the events that are equal in key, time and tie
    found = events.where(asked).select(*keyed, F.col(time).alias(_TIME), F.col(tie).alias(_RANK),
                                       F.struct(*[F.col(c).alias(name) for c, name in carry.items()]).alias(_EVENT))
    found = found.dropDuplicates([*keys, _TIME, _RANK])
    own = probes.where(asked).select(*keyed, F.col(time).alias(_TIME), F.lit(None).cast(found.schema[_RANK].dataType).alias(_RANK),
                                     F.struct(*probes.columns).alias(_ROW))
    both = found.unionByName(own, allowMissingColumns=True)
    # at one time probes come first, then events by falling tie, so that the last one seen is the right one;
    # a hash of the row lets equal probes spread, too
    order = [*keys, _TIME, F.col(_ROW).isNull(), F.col(_RANK).desc_nulls_first(), F.xxhash64(_ROW)]
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{checkpoint_root(spark)}/daybook/asof/{uuid.uuid4().hex}"
    dealt = both.repartitionByRange(n, *order).withColumn(_PART, F.spark_partition_id())
    dealt.write.parquet(folder)
    if stored is not None:
        stored.append(folder)
    dealt = spark.read.schema(dealt.schema).parquet(folder)

    upto = (Window.partitionBy(_PART, *keys).orderBy(*order[len(keys):])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = (dealt.select("*", F.last(_EVENT, ignorenulls=True).over(upto).alias(_SEEN))
            .where(F.col(_ROW).isNotNull()).select(_PART, *keys, _ROW, _SEEN))

    ends = dealt.groupBy(_PART).agg(F.min(F.struct(*keys)).alias("lo"), F.max(F.struct(*keys)).alias("hi"))
    edge = ends.select(F.explode(F.array("lo", "hi")).alias("k")).select("k.*").distinct()
    place = F.struct(F.col(_TIME), F.col(_RANK).isNotNull(), -F.coalesce(F.col(_RANK), F.lit(0)).cast("decimal(20, 0)"))
    last = F.max_by(F.col(_EVENT), F.when(F.col(_ROW).isNull(), place))
    tails = (dealt.join(F.broadcast(edge), keys).groupBy(*keys, _PART)
             .agg(last.alias(_EVENT)))
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    handed = (tails.select(*keys, _PART, F.last(_EVENT, ignorenulls=True).over(earlier).alias("__handed"))
              .where(F.col("__handed").isNotNull()))
    joined = seen.join(F.broadcast(handed), [*keys, _PART], "left").select(
        f"{_ROW}.*", F.coalesce(_SEEN, "__handed").alias(_SEEN))
    result = joined.select(*probes.columns, *[F.col(f"{_SEEN}.{name}").alias(name) for name in out])
    if within is not None:
        kept = F.coalesce(within, F.lit(False))
        result = result.select(*probes.columns, *[F.when(kept, F.col(name)).alias(name) for name in out])
    rest = probes.where(~asked).select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in out.items()])
    return result.unionByName(rest)


def release(spark, stored: list[str]) -> None:
    """Removes the folders of results that are no longer read."""
    while stored:
        delete_folder(spark, stored.pop())
