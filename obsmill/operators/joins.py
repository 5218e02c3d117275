"""Join helper for keys with few distinct values."""

from pyspark.sql import DataFrame, functions as F

#: Rows of the small side that may be broadcast, and splits of a key beyond that.
BROADCAST_ROWS = 20_000
SPLITS = 32


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    spread: list[str],
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join for keys that may hold a third of `big` in one value.

    `small` is counted, up to the bound, and broadcast if it has at most `broadcast_rows` rows.
    Otherwise `big` is split by a hash of `spread` and `small` repeated once per split, so one hot
    key becomes `SPLITS` groups. The repeated side is asked to be merged: its estimate is from
    before the repetition, so a size check of Catalyst's could broadcast it by mistake.
    `how` may be any type that keeps `big`'s rows on the left (inner, left, left_semi, left_anti).
    """
    if small.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return big.join(F.broadcast(small), on, how)
    left = big.withColumn("_split", F.pmod(F.xxhash64(*spread), F.lit(SPLITS)).cast("int"))
    right = small.withColumn("_split", F.explode(F.sequence(F.lit(0), F.lit(SPLITS - 1))))
    return left.join(right.hint("merge"), [*on, "_split"], how).drop("_split")
