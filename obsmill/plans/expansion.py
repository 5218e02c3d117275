"""From plan documents to fetch tasks."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from obsmill.functions import dates, text
from obsmill.operators.joins import salted_join
from obsmill.schemas import REQUEST_SCHEME, TASK, TASK_FIELDS


def flatten_plan(
    plans: DataFrame, plan_id: str = "plan_id", chained: bool = False
) -> DataFrame:
    """One row per concept and ranked source; the position in the list is the rank.

    `chained` keeps the first source only, with the whole list as its `chain` to fail over along.
    """
    concepts = plans.select(
        F.col(plan_id).alias("plan_id"),
        (F.col("mode") == "series").alias("is_series"),
        F.col("date_range.start").alias("start"),
        F.col("date_range.end").alias("end"),
        F.explode("wanted_concepts").alias("concept"),
    )
    ranked = concepts.select("*", F.posexplode("concept.ranked_sources").alias("rank", "ranked"))
    chain = F.transform(
        "concept.ranked_sources",
        lambda entry: F.struct(
            entry["source"].alias("source"),
            entry["function_command"].alias("command"),
            entry["column_name"].alias("column_name"),
        ),
    )
    if chained:
        ranked = ranked.filter(F.col("rank") == 0)
    return ranked.select(
        "plan_id",
        F.coalesce("is_series", F.lit(False)).alias("is_series"),
        F.col("concept.concept_id").alias("concept_id"),
        F.col("concept.code").alias("code"),
        F.col("concept.entity_type").alias("entity_type"),
        text.truthy(F.col("concept.unit"), "").alias("unit"),
        F.col("concept.frequency").alias("frequency"),
        dates.granularity_tag(F.col("concept.granularity"), F.col("concept.frequency")).alias(
            "granularity"
        ),
        "rank",
        F.col("ranked.source").alias("source"),
        F.col("ranked.function_command").alias("command"),
        F.col("ranked.column_name").alias("column"),
        "start",
        "end",
        *([chain.alias("chain")] if chained else []),
    )


def scoped_entities(
    plans: DataFrame, identifiers: DataFrame, plan_id: str = "plan_id"
) -> DataFrame:
    """(plan_id, source, entity_id, identifier) that each plan's scope reaches.

    An explicit id list selects those ids; a null or empty list selects every entity of the
    type. The scope's `filter` text plays no part.
    """
    scopes = plans.select(
        F.col(plan_id).alias("plan_id"),
        F.col("entity_scope.entity_type").alias("entity_type"),
        F.array_distinct("entity_scope.entity_ids").alias("entity_ids"),
    )
    listed = scopes.select("plan_id", "entity_type", F.explode("entity_ids").alias("entity_id"))
    everything = scopes.filter(F.coalesce(F.size("entity_ids"), F.lit(0)) <= 0).select(
        "plan_id", "entity_type"
    )
    columns = ["plan_id", "source", "entity_id", "identifier"]
    by_id = listed.join(identifiers, ["entity_type", "entity_id"]).select(*columns)
    # The type alone is a key of few values, so it may be hot.
    by_type = salted_join(identifiers, everything, ["entity_type"], ["entity_id"]).select(*columns)
    return by_id.unionByName(by_type)


def expand_tasks(
    plans: DataFrame,
    identifiers: DataFrame,
    plan_id: str = "plan_id",
    mode: str | None = None,
    chained: bool = False,
) -> DataFrame:
    """Fetch tasks of the plans: per date, or one per range in series mode.

    Entities join ranges, which are cut and dealt out in even parts before they unfold, so that neither a long
    range nor a large scope makes a long task, and only unexpanded rows shuffle.
    `mode` limits the result to the plans of one mode ("series" or "per_date"). A source is a task
    of its own, or with `chained` a concept is, carrying its ranked sources in `chain`.
    """
    from obsmill.plans import ranges

    found = ranges.task_ranges(plans, identifiers, plan_id, mode, chained)
    return ranges.expand(ranges.balanced(found)).select(
        "plan_id", "rank", *TASK_FIELDS, *(["chain"] if chained else [])
    )


def _pairs(names: list[str]) -> list[Column]:
    pairs = []
    for field in [TASK[name] for name in names]:
        value = F.col(field.name)
        # Numbers have nothing to encode.
        encoded = text.form_encode(value) if field.dataType == T.StringType() else value.cast("string")
        pairs.append(F.when(value.isNotNull(), F.concat(F.lit(f"{field.name}="), encoded)))
    return pairs


def _place() -> Column:
    return F.concat(F.lit(REQUEST_SCHEME), F.col("source"), F.lit("/"), text.path_quote(F.col("command")), F.lit("?"))


def request_key() -> Column:
    """Text identity of a task over all its non-null fields."""
    return F.concat(_place(), F.concat_ws("&", *_pairs(TASK_FIELDS)))


def request_key_parts() -> dict[str, Column]:
    """What the keys of a range's tasks have in common: the text before and after their date."""
    at = TASK_FIELDS.index("date")
    return {
        "_place": _place(),
        "_before": F.concat_ws("&", *_pairs(TASK_FIELDS[:at])),
        "_after": F.concat_ws("&", *_pairs(TASK_FIELDS[at + 1 :])),
    }


def joined_request_key() -> Column:
    """`request_key` of a task that has its range's `request_key_parts`."""
    date = F.col("date")
    # A plain day has nothing to encode either.
    encoded = F.when(F.length(date) == 10, date).otherwise(text.form_encode(date))
    dated = F.when(date.isNotNull(), F.concat(F.lit("date="), encoded))
    given = [F.nullif(F.col("_before"), F.lit("")), dated, F.nullif(F.col("_after"), F.lit(""))]
    return F.concat("_place", F.concat_ws("&", *given))


def distinct_tasks(tasks: DataFrame) -> DataFrame:
    """Tasks without repeats, keyed, with their best `rank`.

    The key covers all task fields, so distinct fields and distinct keys are the same thing; the
    fields aggregate by hash and map-side, and the long key is built once per survivor.
    """
    kept = [*TASK_FIELDS, *(["chain"] if "chain" in tasks.columns else [])]
    best = F.min("rank").alias("rank")
    return tasks.groupBy(*kept).agg(best).withColumn("request_key", request_key())


def unseen_tasks(tasks: DataFrame, seen: DataFrame, key: str = "request_key") -> DataFrame:
    """Tasks whose key no earlier run has recorded."""
    return tasks.join(seen.select(key), key, "left_anti")


def plan_size(plans: DataFrame, identifiers: DataFrame, plan_id: str = "plan_id") -> DataFrame:
    """Task counts per concept and source, from entity counts and spine lengths: no expansion."""
    flat = flatten_plan(plans, plan_id)
    per_entity = F.when(F.col("is_series"), F.lit(1).cast("bigint")).otherwise(
        dates.spine_size(F.col("start"), F.col("end"), F.col("frequency"))
    )
    entities = (
        scoped_entities(plans, identifiers, plan_id)
        .groupBy("plan_id", "source")
        .agg(F.count("*").alias("entities"))
    )
    return (
        flat.withColumn("per_entity", per_entity)
        .join(entities, ["plan_id", "source"])
        .groupBy("concept_id", "source")
        .agg(
            F.sum("entities").alias("entities"),
            F.sum(F.col("entities") * F.col("per_entity")).alias("tasks"),
        )
    )


def plan_totals(plans: DataFrame, identifiers: DataFrame, plan_id: str = "plan_id") -> DataFrame:
    """`plan_size` with totals: of each concept (null source) and of all plans (null concept and source)."""
    sizes = plan_size(plans, identifiers, plan_id)
    return sizes.rollup("concept_id", "source").agg(F.sum("entities").alias("entities"), F.sum("tasks").alias("tasks"))
