"""What several operators of this folder need: text helpers, remainders, ranks, components."""

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from obsmill.sinks.paths import written

#: The characters of `[\x20\x09-\x0D]`.
TEXT_SPACE = " \t\n\x0b\x0c\r"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Identifiers that may be broadcast; a documented bound, some 64 MB at most.
BROADCAST_KEYS = 1_000_000
#: Lets Spark remove a query's shuffle files as soon as its table is written, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session for all frames that are made and tables that are written meanwhile."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def remainder(identifier: str, modulus: int) -> Column:
    """crc32 of the identifier as text, modulo `modulus`; null for a null identifier."""
    return F.pmod(F.crc32(F.col(identifier).cast("string").cast("binary")), F.lit(modulus))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (splitmix finaliser)."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(words: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all runs of `width` word hashes."""
    runs = len(words) - width + 1
    total = words[:runs].copy()
    for k in range(1, width):
        total = total * _MULTIPLIER + words[k : runs + k]
    return mixed(total)


def pieces(texts: list[str], limit: int) -> Iterator[range]:
    """Ranges of consecutive texts of at most `limit` characters in sum, or one text."""
    begin = held = 0
    for k, text in enumerate(texts):
        if k > begin and held + len(text) > limit:
            yield range(begin, k)
            begin, held = k, 0
        held += len(text)
    if begin < len(texts):
        yield range(begin, len(texts))


def matching(frame: DataFrame, keys: DataFrame, key: str | list[str], how: str = "left_semi") -> DataFrame:
    """Rows of `frame` whose `key` is (left_semi) or isn't (left_anti) among the distinct `keys`.

    Up to `BROADCAST_KEYS` keys are broadcast, so that wide rows stay where they are; more are
    joined by a shuffle. `keys` should be a written table: it is counted first.
    """
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return frame.join(F.broadcast(keys) if few else keys, key, how)


def gapless(frame: DataFrame, group: list[str], chunk: list[str], order: list[str], name: str) -> DataFrame:
    """Adds `name`: the row's number from 0 within `group`, by `chunk`, then `order`.

    A group is never ordered in one task: rows are numbered within their chunk, and a running sum
    over the chunks' counts, one row each, gives where a chunk begins. Keys must not be null; the
    numbering and the join then share one exchange of the rows.
    """
    keys = [*group, *chunk]
    over = Window.partitionBy(*group).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        frame.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .select(*keys, F.coalesce(F.sum("_rows").over(over), F.lit(0)).alias("_begin"))
    )
    inner = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return (
        frame.withColumn("_inner", inner)
        .join(begins, keys)
        .withColumn(name, F.col("_begin") + F.col("_inner"))
        .drop("_begin", "_inner")
    )


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge; root is the least node that links reach.

    Alternating large-star and small-star rounds: every node's neighbours are hung on the least of
    them until all hang on a root. Each round is one written table in the shared folder. The
    minimum over a node's edges is combined before the shuffle; joins split a hub by size.
    """
    high, low = F.greatest(a, b).cast("long"), F.least(a, b).cast("long")
    linked = F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    edges = written(edges.filter(linked).select(high.alias("u"), low.alias("v")).distinct(), "edges")
    state = None
    while True:
        seen = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1000003)).first()
        if seen == state or seen[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        state = seen
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(hung.union(least.select("u", "m")).distinct(), "edges")
