"""Endpoint registry: extraction from listing pages, budget, validity, upsert, retirement."""

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from obsmill.functions.text import percentage
from obsmill.schemas import (
    ENDPOINT_FETCH_COUNT,
    ENDPOINT_LABEL,
    ENDPOINT_REGISTRY,
    IPV4_PATTERN,
    PORT_CELL_PATTERN,
    PROBE_TARGETS,
    STALE_MINUTES,
)
from obsmill.sinks.paths import written

ENDPOINT = ["ip", "port"]


def page_matches(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds all IPv4-shaped texts and all table cells of two to five digits, in page order."""
    return pages.withColumns(
        {
            "ips": F.regexp_extract_all(html, F.lit(IPV4_PATTERN), 1),
            "ports": F.regexp_extract_all(html, F.lit(PORT_CELL_PATTERN), 1),
        }
    )


def pair_endpoints(pages: DataFrame, source: str = "source") -> DataFrame:
    """(source, source_rank, pos, scheme, ip, port): addresses and ports paired by position in the page.

    The longer list is cut; ports outside 1..65535 drop out after pairing. A page without a rank
    counts as rank 0.
    """
    rank = F.coalesce("source_rank", F.lit(0)).alias("source_rank")
    pairs = page_matches(pages).select(
        F.col(source).alias("source"), rank, F.posexplode(F.arrays_zip("ips", "ports")).alias("pos", "pair")
    )
    port = F.col("pair.ports").cast("int")
    return pairs.filter(F.col("pair.ips").isNotNull() & port.between(1, 65535)).select(
        "source", "source_rank", "pos", F.lit("http").alias("scheme"), F.col("pair.ips").alias("ip"),
        port.alias("port"),
    )


def within_budget(endpoints: DataFrame, budget: int = ENDPOINT_FETCH_COUNT) -> DataFrame:
    """Rows of the sources that are read, by `source_rank`, until `budget` rows are gathered.

    Repeats count. A source is used if the sources before it hold fewer than `budget` rows. Every
    source counted here has a row, so the last one used is among the first `budget` sources: the
    running total runs over at most that many counts, the rest is a comparison with the last rank.
    """
    counts = endpoints.groupBy("source_rank").agg(F.count("*").alias("rows"))
    leading = counts.orderBy("source_rank").limit(budget)
    before = Window.orderBy("source_rank").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        leading.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .filter(F.col("before") < budget)
        .agg(F.max("source_rank").alias("last_rank"))
    )
    # One row, so the broadcast is of fixed size.
    return endpoints.join(F.broadcast(last), F.col("source_rank") <= F.col("last_rank")).drop("last_rank")


def first_seen(endpoints: DataFrame) -> DataFrame:
    """The first row of each (ip, port) by the source's rank and position; reduced map-side."""
    first = F.min(F.struct("source_rank", "pos", "source", "scheme")).alias("first")
    return endpoints.groupBy(*ENDPOINT).agg(first).select(
        "first.source", "first.source_rank", "first.pos", "first.scheme", *ENDPOINT
    )


def first_n(endpoints: DataFrame, n: int = ENDPOINT_FETCH_COUNT) -> DataFrame:
    return endpoints.orderBy("source_rank", "pos").limit(n)


def gather(pages: DataFrame, n: int = ENDPOINT_FETCH_COUNT) -> DataFrame:
    """The first `n` distinct endpoints of the listing pages.

    The pages are scanned once: their pairs, a small part of the text, are written and then read
    for the counts and for the rows.
    """
    pairs = written(pair_endpoints(pages), "pairs")
    return first_n(first_seen(within_budget(pairs, n)), n)


def with_targets(endpoints: DataFrame, targets: list[str] = PROBE_TARGETS) -> DataFrame:
    """One row per endpoint and probe target, as an explode of a literal list."""
    return endpoints.withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets])))


def probe_results(
    endpoints: DataFrame, probes: DataFrame, below: int = 600, targets: list[str] = PROBE_TARGETS
) -> DataFrame:
    """Adds `passed` per endpoint and target: an HTTP status under `below`.

    A null status (an exception) or a missing probe fails. `probes` holds one row per probe; the
    last 0/1 outcome per (endpoint, target) is reduced before the join.
    """
    outcome = probes.groupBy(*ENDPOINT, "target").agg(
        F.max(F.coalesce(F.col("status") < below, F.lit(False))).alias("passed")
    )
    joined = with_targets(endpoints, targets).join(outcome, [*ENDPOINT, "target"], "left")
    return joined.withColumn("passed", F.coalesce("passed", F.lit(False)))


def valid_endpoints(
    endpoints: DataFrame, probes: DataFrame, below: int = 600, targets: list[str] = PROBE_TARGETS
) -> DataFrame:
    """Endpoints that passed for at least one target.

    Validity needs the passing probes only, so it is a semi join without the target fan-out.
    """
    passing = probes.filter((F.col("status") < below) & F.col("target").isin(*targets))
    # Distinct first: an endpoint with very many probes sends one row per task.
    return endpoints.join(passing.select(*ENDPOINT).distinct(), ENDPOINT, "left_semi")


def success_rates(results: DataFrame, targets: list[str] = PROBE_TARGETS) -> DataFrame:
    """Passed, tried and percentage per target, plus an `overall` row over endpoints.

    An endpoint's outcomes, one per target, meet once and unfold into its targets and the overall
    row, so the results are computed once. Targets never tried show zeros.
    """
    outcome = F.struct("target", "passed")
    overall = F.struct(F.lit("overall").alias("target"), F.max("passed").alias("passed"))
    per_endpoint = results.groupBy(*ENDPOINT).agg(
        F.concat(F.collect_list(outcome), F.array(overall)).alias("outcomes")
    )
    counted = (
        per_endpoint.select(F.inline("outcomes"))
        .groupBy("target")
        .agg(F.count_if("passed").alias("passed"), F.count("*").alias("tried"))
    )
    untried = results.sparkSession.createDataFrame(
        [(name, 0, 0) for name in [*targets, "overall"]], "target STRING, passed BIGINT, tried BIGINT"
    )
    sums = counted.unionByName(untried).groupBy("target").agg(
        F.sum("passed").alias("passed"), F.sum("tried").alias("tried")
    )
    return sums.withColumn("rate", percentage(F.col("passed"), F.col("tried")))


def _known(registry: DataFrame, fresh: DataFrame) -> DataFrame:
    """(ip, port) of `fresh` that the registry holds."""
    return registry.select(*ENDPOINT).join(fresh.select(*ENDPOINT), ENDPOINT, "left_semi").distinct()


def _stamp(moment: datetime) -> Column:
    """A zone-free literal: neither the session's nor the driver's zone shifts it."""
    return F.lit(moment.isoformat(" ")).cast("timestamp_ntz")


def upsert(registry: DataFrame, fresh: DataFrame, now: datetime) -> DataFrame:
    """Registry with `fresh` (unique per ip and port) put in, keyed on (ip, port).

    A hit becomes active, is no longer retired and is updated at `now`; a miss is inserted
    without credentials and without an id, which the store gives out. Two joins rather than a
    full outer one: with a small `fresh` neither needs to shuffle the registry. `fresh` is read
    three times, so pass a written table.
    """
    at = _stamp(now)
    hits = registry.join(
        fresh.select(*ENDPOINT, F.lit(True).alias("_hit")), ENDPOINT, "left"
    ).withColumns(
        {
            "status": F.when(F.col("_hit"), F.lit("active")).otherwise(F.col("status")),
            "retired_at": F.when(F.col("_hit").isNull(), F.col("retired_at")),
            "updated_at": F.when(F.col("_hit"), at).otherwise(F.col("updated_at")),
        }
    )
    misses = fresh.join(_known(registry, fresh), ENDPOINT, "left_anti").select(
        F.lit(None).cast("bigint").alias("id"),
        "scheme",
        "ip",
        "port",
        F.lit(None).cast("string").alias("auth"),
        F.lit("active").alias("status"),
        F.lit(ENDPOINT_LABEL).alias("label"),
        at.alias("created_at"),
        at.alias("updated_at"),
        F.lit(None).cast("timestamp_ntz").alias("retired_at"),
    )
    columns = ENDPOINT_REGISTRY.fieldNames()
    return hits.select(*columns).unionByName(misses.select(*columns))


def is_stale(now: datetime, minutes: int = STALE_MINUTES) -> Column:
    cutoff = _stamp(now - timedelta(minutes=minutes))
    return (F.col("status") == "active") & (
        F.col("updated_at").isNull() | (F.col("updated_at") < cutoff)
    )


def retire(registry: DataFrame, now: datetime, minutes: int = STALE_MINUTES) -> DataFrame:
    """Registry with active rows not updated for more than `minutes` marked as retired."""
    stale = is_stale(now, minutes)
    return registry.withColumns(
        {
            "status": F.when(stale, F.lit("retired")).otherwise(F.col("status")),
            "retired_at": F.when(stale, _stamp(now)).otherwise(
                F.col("retired_at")
            ),
        }
    )


def changes(before: DataFrame, after: DataFrame, now: datetime) -> DataFrame:
    """One row: endpoints that a refresh at `now` touched (updated or inserted), inserted and retired.

    Each is stamped with `now` in `after`; `before` only tells how many rows there were.
    """
    at = _stamp(now)
    known = before.agg(F.count("*").alias("_rows"))
    stamped = after.agg(
        F.count_if(F.col("updated_at") == at).alias("touched"),
        F.count("*").alias("_all"),
        F.count_if(F.col("retired_at") == at).alias("retired"),
    )
    # Both sides are one row of a global aggregate.
    both = stamped.join(F.broadcast(known))
    return both.select("touched", (F.col("_all") - F.col("_rows")).alias("inserted"), "retired")


def refresh(
    registry: DataFrame,
    pages: DataFrame,
    probes: DataFrame,
    now: datetime,
    n: int = ENDPOINT_FETCH_COUNT,
) -> DataFrame:
    """One round: gather, validate, upsert, retire. With nothing valid the registry stays as is.

    The valid endpoints, at most `n`, are written once and then read by the check and the joins.
    """
    valid = written(valid_endpoints(gather(pages, n), probes), "valid-endpoints")
    if valid.isEmpty():
        return registry
    return retire(upsert(registry, valid, now), now)
