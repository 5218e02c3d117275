"""Fetch tasks as ranges of steps: made distinct, compared with earlier runs and balanced, unexpanded.

A step is a day, month or year as an integer, a range its first and last step. A sweep over the ends of
ranges gives their union, the best rank of every step and the difference to what earlier runs took, so
nothing that is as large as the tasks themselves is ever shuffled.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from obsmill.functions import dates
from obsmill.operators.joins import salted_join
from obsmill.plans.expansion import flatten_plan, scoped_entities
from obsmill.schemas import TASK, TASK_FIELDS
from obsmill.sinks.paths import exists, written

#: What a range has in common with each of its tasks; `axis` says what its steps are.
AXIS = "axis"
SERIES = "series"
FIELDS = [c for c in TASK_FIELDS if c != "date"]
KEY = [*FIELDS, AXIS]
#: The fields that a concept's source alone decides.
CONCEPT = ["source", "command", "column", "concept_id", "entity_type", "unit", "granularity"]
RANGE = T.StructType(
    [
        *[f for f in TASK.fields if f.name != "date"],
        T.StructField(AXIS, T.StringType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
    ]
)
#: Steps of one run, and tasks that one partition expands at most.
RUN = 512
TASKS_PER_PARTITION = 1_000_000
#: Ranks that one integer of marks holds.
MARKS = 62


def task_ranges(
    plans: DataFrame, identifiers: DataFrame, plan_id: str = "plan_id", mode: str | None = None, chained: bool = False
) -> DataFrame:
    """The tasks of the plans, a row per concept, source and entity: plan_id, rank, KEY, first, last.

    A series task is one step of an axis of its own and keeps its unswapped bounds. `mode` and `chained`
    are those of `expand_tasks`. Plans without a date range have no per-date tasks.
    """
    flat = flatten_plan(plans, plan_id, chained)
    if mode is not None:
        flat = flat.filter(F.col("is_series") == (mode == SERIES))
        plans = plans.filter(F.coalesce(F.col("mode") == SERIES, F.lit(False)) == (mode == SERIES))
    first, last = dates.spine_steps(F.col("start"), F.col("end"), F.col("frequency"))
    series = F.col("is_series")
    ranged = (
        scoped_entities(plans, identifiers, plan_id)
        .join(flat, ["plan_id", "source"])
        .withColumns(
            {
                AXIS: F.when(series, F.lit(SERIES)).otherwise(dates.cadence(F.col("frequency"))),
                "first": F.when(series, F.lit(0)).otherwise(first).cast("long"),
                "last": F.when(series, F.lit(0)).otherwise(last).cast("long"),
                "start": F.when(series, F.col("start")),
                "end": F.when(series, F.col("end")),
            }
        )
    )
    chain = ["chain"] if chained else []
    return ranged.filter("first IS NOT NULL").select("plan_id", "rank", *KEY, *chain, "first", "last")


def cut_runs(ranges: DataFrame, run: int = RUN) -> DataFrame:
    """Ranges of at most `run` steps."""
    begins = F.explode(F.sequence("first", "last", F.lit(run).cast("long"))).alias("_first")
    others = [c for c in ranges.columns if c not in ("first", "last")]
    return ranges.select(*others, "last", begins).select(
        *others, F.col("_first").alias("first"), F.least(F.col("_first") + (run - 1), F.col("last")).alias("last")
    )


def balanced(
    ranges: DataFrame, partitions: int | None = None, run: int = RUN, most: int = TASKS_PER_PARTITION
) -> DataFrame:
    """The same steps as short ranges, dealt out so that all partitions expand to about as many tasks.

    Ranges are cut into runs, which are dealt round in the order of their hashes, equal ones too, so that partitions
    have as many runs each, of mixed lengths: with T tasks a partition, the spread of T is about sqrt(run / T) at
    most. One exchange, no sort by the ranges' fields. `ranges` is written first, for it is summed up
    before it is dealt. Partitions are at least as many as for other shuffles, and hold about `most` tasks at most.
    """
    spark = ranges.sparkSession
    whole = written(ranges, "ranges")
    total = whole.agg(F.sum(F.col("last") - F.col("first") + 1)).first()[0] or 0
    least = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = max(least, -(-total // most), 1)
    return cut_runs(whole, run).repartition(count)


def expand(ranges: DataFrame) -> DataFrame:
    """The tasks of ranges; further columns stay."""
    others = [c for c in ranges.columns if c not in (*KEY, "first", "last")]
    stepped = ranges.withColumn("_step", F.explode(F.sequence("first", "last")))
    date = F.when(F.col(AXIS) != SERIES, dates.step_text(F.col(AXIS), F.col("_step"))).alias("date")
    return stepped.select(*others, *[date if c == "date" else c for c in TASK_FIELDS])


def _concept() -> Column:
    return F.xxhash64(*CONCEPT)


def _one_axis(ranges: DataFrame, mixed: DataFrame) -> DataFrame:
    """Ranges of `mixed` concepts as ranges of days: a month or year becomes its one day.

    Two cadences under one granularity tag may name one task; on one axis they meet. Those ranges
    are the only ones that unfold, and only those of months and years.
    """
    marked = salted_join(ranges.withColumn("_concept", _concept()), mixed, ["_concept"], ["entity_id", "first"], "left")
    sparse = F.col("_mixed").isNotNull() & F.col(AXIS).isin("month", "year")
    steps = F.when(sparse, F.sequence("first", "last")).otherwise(F.array("first"))
    unfolded = marked.withColumn("_sparse", sparse).withColumn("_step", F.explode(steps))
    day = F.when(F.col("_sparse"), F.unix_date(dates.step_date(F.col(AXIS), F.col("_step")))).cast("long")
    return (
        unfolded.withColumns(
            {
                "first": F.coalesce(day, "_step"),
                "last": F.coalesce(day, "last"),
                AXIS: F.when(F.col("_sparse"), F.lit("day")).otherwise(F.col(AXIS)),
            }
        )
        .drop("_concept", "_mixed", "_sparse", "_step")
    )


def mixed_concepts(*kinds: DataFrame) -> DataFrame:
    """Hashes of the concepts of `kinds` (CONCEPT, axis) that have more than one cadence."""
    every = reduce(DataFrame.union, [k.select(_concept().alias("_concept"), AXIS) for k in kinds])
    # Distinct pairs first: those aggregate by hash.
    found = every.filter(F.col(AXIS) != SERIES).distinct().groupBy("_concept").count()
    return found.filter("count > 1").select("_concept", F.lit(True).alias("_mixed"))


def swept(
    ranges: DataFrame, key: list[str], taken: DataFrame | None = None, ranks: int = 1, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Disjoint ranges (key, rank, first, last) of the steps that `ranges` cover and `taken` doesn't.

    `ranges` has key, rank (from 0, below `ranks`), first and last; a step has the least rank of the ranges
    that cover it. `taken` has key, first and last. Null key parts equal each other. Adjacent ranges of one rank are one,
    but where a taken range or another rank lies between them. Of a `carry` column a key keeps the least value.

    Of ranges with one key, rank and begin the longest stays, found map-side: a hot key then has as
    many rows as there are steps, at most. The union of each rank and the sweep over all
    ends share one exchange, and sort by a hash of the key before the key itself. A mark in an integer says which
    ranks cover a step.
    """
    words = -(-ranks // MARKS)
    marks = [f"_mark{w}" for w in range(words)]
    one = ranges.groupBy(*key, "rank", "first").agg(F.max("last").alias("last"), *[F.min(c).alias(c) for c in carry])
    if taken is not None:
        theirs = taken.groupBy(*key, "first").agg(F.max("last").alias("last"))
        one = one.unionByName(theirs.withColumn("rank", F.lit(None).cast("int")), allowMissingColumns=True)
    together = one.repartition(*key).withColumn("_hash", F.xxhash64(*key))
    hashed = ["_hash", *key]
    whole = Window.partitionBy(*hashed)
    together = together.withColumns({c: F.min(c).over(whole) for c in carry})
    # Within a rank: where the union begins anew, and where it ended before.
    by_rank = Window.partitionBy(*hashed, "rank").orderBy("first")
    reach = F.max("last").over(by_rank.rowsBetween(Window.unboundedPreceding, -1))
    unions = together.withColumns({"_reach": reach, "_final": F.lead("first").over(by_rank).isNull()})
    anew = F.col("_reach").isNull() | (F.col("first") > F.col("_reach") + 1)
    ends = F.array(
        F.when(anew, F.struct(F.col("first").alias("at"), F.lit(1).alias("sign"))),
        F.when(anew & F.col("_reach").isNotNull(), F.struct((F.col("_reach") + 1).alias("at"), F.lit(-1).alias("sign"))),
        F.when(
            F.col("_final"), F.struct((F.greatest("_reach", "last") + 1).alias("at"), F.lit(-1).alias("sign"))
        ),
    )
    events = unions.select(*hashed, *carry, "rank", F.explode(ends).alias("_e")).filter("_e IS NOT NULL")
    deltas = {"_taken": F.when(F.col("rank").isNull(), F.col("_e.sign")).otherwise(F.lit(0))}
    for w, name in enumerate(marks):
        own = F.col("rank").between(w * MARKS, w * MARKS + MARKS - 1)
        bit = F.expr(f"shiftleft(cast(1 as bigint), cast(coalesce(rank, 0) as int) - {w * MARKS})")
        deltas[name] = F.when(own, F.col("_e.sign") * bit).otherwise(F.lit(0).cast("long"))
    sweep = Window.partitionBy(*hashed).orderBy("at")
    upto = sweep.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = (
        events.select(*hashed, *carry, F.col("_e.at").alias("at"), *[v.alias(c) for c, v in deltas.items()])
        .withColumns({c: F.sum(c).over(upto) for c in deltas} | {"_next": F.lead("at").over(sweep)})
        .filter(F.col("_next") > F.col("at"))
    )
    lowest = [
        F.when(F.col(c) != 0, F.expr(f"cast(bit_count(({c} & -{c}) - 1) as int) + {w * MARKS}"))
        for w, c in enumerate(marks)
    ]
    ranked = summed.filter("_taken = 0").withColumn("rank", F.coalesce(*lowest)).filter("rank IS NOT NULL")
    return ranked.select(*key, *carry, "rank", F.col("at").alias("first"), (F.col("_next") - 1).alias("last"))


def distinct_ranges(
    plans: DataFrame,
    identifiers: DataFrame,
    taken: DataFrame | None = None,
    plan_id: str = "plan_id",
    mode: str | None = None,
    chained: bool = False,
) -> DataFrame:
    """Ranges (rank, KEY, first, last) of the plans' distinct tasks that `taken` ranges don't hold.

    A task's identity is all its fields. It has the best rank that any plan gives it, and with `chained` the
    least of the chains that plans give its range's fields. Plans meet their entities once; of `taken` only the
    ranges of the plans' own concepts are compared.
    """
    ranges = task_ranges(plans, identifiers, plan_id, mode, chained)
    flat = flatten_plan(plans, plan_id)
    axis = F.when(F.col("is_series"), F.lit(SERIES)).otherwise(dates.cadence(F.col("frequency"))).alias(AXIS)
    kinds = [flat.select(*CONCEPT, axis)]
    if taken is not None:
        wanted = flat.select(_concept().alias("_concept")).distinct()
        named = taken.withColumn("_concept", _concept())
        taken = salted_join(named, wanted, ["_concept"], ["entity_id", "first"], "left_semi").drop("_concept")
        kinds.append(taken)
    mixed = written(mixed_concepts(*kinds), "mixed")
    ranks = (flat.agg(F.max("rank")).first()[0] or 0) + 1
    taken = None if taken is None else _one_axis(taken, mixed)
    return swept(_one_axis(ranges, mixed), KEY, taken, ranks, ("chain",) if chained else ())


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    """The ranges that earlier runs have taken; empty before the first."""
    if not exists(spark, path):
        return spark.createDataFrame([], RANGE)
    return spark.read.schema(RANGE).parquet(path)


def record_ranges(ranges: DataFrame, path: str) -> None:
    """Adds a run's ranges to those taken. To be called once its tasks are written."""
    ranges.select(*RANGE.fieldNames()).write.mode("append").parquet(path)
