"""Joins of snapshot data: change points, nearest in time, set comparison of two sources, exact keys, next event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows that a task gets of what it puts in order or holds, about.
TASK_ROWS = 500_000


def tasks_for(df: DataFrame, rows: int = TASK_ROWS) -> int:
    """How many tasks df's rows need to get about `rows` each, one a core at least; rows are counted.

    For repartition(): sizes of shuffled bytes, by which Spark joins partitions, tell little of the memory that rows
    take, since sorted keys shrink to a twentieth."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def change_points(df: DataFrame, values: Sequence[str], order: str, keys: Sequence[str] = ()) -> DataFrame:
    """The first row of each run of equal values."""
    w = Window.partitionBy(*keys).orderBy(order)
    now = F.struct(*values)
    return df.withColumn("_n", ~now.eqNullSafe(F.lag(now).over(w))).where("_n").drop("_n")


def nearest(left: DataFrame, right: DataFrame, left_at: str, right_at: str, seconds: int, keys: Sequence[str] = ()) -> DataFrame:
    """Each left row with the right row nearest in time within a bound, the earlier one at a tie; unmatched rows stay.

    Both sides get buckets as wide as the bound and a left row looks into three of them, so this is a join of equal
    keys that shuffles each side once and needs no order."""
    keys = list(keys)
    bucket = lambda c: F.floor(F.unix_micros(c) / (seconds * 1_000_000))
    l = left.withColumn("_b", F.explode(F.array(*[bucket(F.col(left_at)) + i for i in (-1, 0, 1)])))  # noqa: E741
    r = right.withColumn("_b", bucket(F.col(right_at)))
    apart = F.abs(F.unix_micros(right_at) - F.unix_micros(left_at))
    hit = F.when(F.col(right_at).isNotNull() & (apart <= seconds * 1_000_000), F.struct(apart.alias("apart"), *[c for c in [right_at] + [x for x in right.columns if x != right_at and x not in keys]]))
    joined = l.join(r, [*keys, "_b"], "left").withColumn("_hit", hit)
    best = joined.groupBy(*left.columns).agg(F.min("_hit").alias("_hit"))
    own = [c for c in right.columns if c not in keys]
    return best.select(*left.columns, *[F.col(f"_hit.{c}").alias(c) for c in own], (F.col("_hit.apart") / 1_000_000).alias("seconds_apart"))


def compared_sets(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of two sets of keys with flags in_left and in_right."""
    a = left.select(*keys).distinct().withColumn("in_left", F.lit(True))
    b = right.select(*keys).distinct().withColumn("in_right", F.lit(True))
    return a.join(b, list(keys), "full_outer").select(*keys, F.coalesce("in_left", F.lit(False)).alias("in_left"), F.coalesce("in_right", F.lit(False)).alias("in_right"))


def field_agreement(left: DataFrame, right: DataFrame, key: str, fields: dict[str, Column]) -> DataFrame:
    """(field, class, n) over shared entities; fields give a class from the two sides' columns l.x and r.x."""
    both = left.alias("l").join(right.alias("r"), key)
    wide = both.select(*[c.alias(n) for n, c in fields.items()])
    long = wide.unpivot([], list(fields), "field", "class")
    return long.groupBy("field", "class").agg(F.count("*").alias("n"))


def modal(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The commonest value per group, the smaller label at a tie."""
    n = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return n.groupBy(*keys).agg(F.min(F.struct(-F.col("_n"), F.col(value))).alias("_m")).select(*keys, F.col(f"_m.{value}").alias(value))


def listed_entities(cases: DataFrame, listed: DataFrame, tasks: int | None = None) -> DataFrame:
    """(entity, family), each once: entities of which a family lists a case. cases: (entity, case_no), listed: (family,
    case_no); both may repeat rows.

    Cases meet one row per listed case, with its families, and are dealt by case and by entity to as many `tasks` as
    their number asks for; families unfold only then, within the task that has all rows of an entity. The result stays
    dealt by entity."""
    tasks = tasks or tasks_for(cases)
    families = listed.select("family", "case_no").distinct().groupBy("case_no").agg(F.collect_list("family").alias("family"))
    j = cases.select("entity", "case_no").repartition(tasks, "case_no").join(families.hint("shuffle_hash"), "case_no")
    return j.select("entity", "family").repartition(tasks, "entity").select("entity", F.explode("family").alias("family")).dropDuplicates(["entity", "family"])


def next_event(events: DataFrame, owner: str, entity: str, first_seen: str, end: str, seconds: int = 86_400 * 32, tasks: int | None = None) -> DataFrame:
    """(entity, owner, end, next_seen): when another entity of the same owner, first seen later than this one and not
    before the day of its end, is first seen; null if none is.

    Both conditions bound the time from below. Times are cut in buckets of `seconds`: the first time in the asked bucket
    that is late enough comes from one ordered pass over an owner's bucket, else the least time of the owner's next
    bucket that has any, from a pass over one row per owner and bucket. Rows are dealt by owner and bucket to as many
    `tasks` as their number asks for (see tasks_for(); by default events are counted), so no task holds more than its
    share of rows and a bucket of an owner, however many the owner or the table has. Passes run from the latest time
    down, as running minima. Blank owners are left out."""
    tasks = tasks or tasks_for(events)
    bucket = F.floor(F.col("_at") / (seconds * 1_000_000)).cast("long").alias("_b")
    t = F.unix_micros(first_seen)
    ask = F.struct(F.col(entity), F.col(end), F.when(t.isNotNull(), F.greatest(t + 1, F.unix_micros(F.col(end).cast("timestamp")))).alias("_at"), F.lit(None).cast("long").alias("_t"))
    none = [F.lit(None).cast(events.schema[c].dataType).alias(c) for c in (entity, end)]
    both = F.array(F.when(F.col(end).isNotNull(), ask), F.when(t.isNotNull(), F.struct(*none, t.alias("_at"), t.alias("_t"))))
    e = events.where(F.col(owner) != "").select(owner, F.explode(F.filter(both, lambda x: x.isNotNull())).alias("x")).select(owner, "x.*")
    e = e.select("*", bucket).repartition(tasks, owner, "_b")
    near = e.withColumn("_near", F.min("_t").over(Window.partitionBy(owner, "_b").orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, Window.currentRow))).where(F.col(entity).isNotNull())
    # one row per owner and bucket: its least time, and the least of the next bucket with times
    least = e.groupBy(owner, "_b").agg(F.min("_t").alias("_least")).repartition(tasks, owner)
    after = Window.partitionBy(owner).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    far = least.select(owner, "_b", F.min("_least").over(after).alias("_far")).where("_far is not null").repartition(tasks, owner, "_b")
    out = near.join(far, [owner, "_b"], "left")
    return out.select(entity, owner, end, F.timestamp_micros(F.coalesce("_near", "_far")).alias("next_seen"))
