"""Sharding by Karmarkar-Karp differencing of indivisible groups."""

import heapq

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from obsmill.llm.shared import gapless
from obsmill.sinks.paths import written

SHARDS = 16
#: Groups that one task differences; what a task leaves is one partial partition of SHARDS sums.
GROUPS_PER_TASK = 20_000
#: Partial partitions that are differenced together, and columns of the result.
PARTIALS = 2_000
RESULT = ("size", "text_crc32", "shard", "slot")
SLOT_CHUNKS = 256


def difference(partials: list[list[int]]) -> list[list[int]]:
    """For each partial partition, the final part of each of its sums.

    The two partitions of largest spread are combined again and again, oppositely ordered: the
    largest sum of one goes to the smallest of the other. Ties go by age, so reruns agree.
    """
    if not partials:
        return []
    width = len(partials[0])
    sums = [list(p) for p in partials]
    merges: list[tuple] = []
    heap = []
    for k, p in enumerate(sums):
        heapq.heappush(heap, (min(p) - max(p), k))
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        rise = sorted(range(width), key=sums[a].__getitem__)
        fall = sorted(range(width), key=lambda k: -sums[b][k])
        node = len(sums)
        sums.append([sums[a][x] + sums[b][y] for x, y in zip(rise, fall)])
        sums[a] = sums[b] = None
        merges.append((node, a, rise, b, fall))
        heapq.heappush(heap, (min(sums[node]) - max(sums[node]), node))
    place = {heap[0][1]: list(range(width))}
    for node, a, rise, b, fall in reversed(merges):
        at = place.pop(node)
        for child, order in ((a, rise), (b, fall)):
            own = [0] * width
            for part, slot in enumerate(order):
                own[slot] = at[part]
            place[child] = own
    return [place[k] for k in range(len(partials))]


def _by_task(shards: int):
    def assign(groups: pd.DataFrame) -> pd.DataFrame:
        groups = groups.sort_values(["_bytes", "_key"], ascending=[False, True], ignore_index=True)
        placed = difference([[0] * (shards - 1) + [int(b)] for b in groups["_bytes"]])
        groups["_part"] = pd.Series([p[-1] for p in placed], dtype="int32")
        return groups[["_key", "_bytes", "_task", "_part"]]

    return assign


def _wide(sums: DataFrame, shards: int) -> DataFrame:
    return sums.groupBy("_task").pivot("_part", list(range(shards))).agg(F.sum("_bytes")).na.fill(0)


def _by_level(shards: int):
    """Task function: partial partitions (a row of sums each) to one, and where each part of them goes."""

    def combine(partials: pd.DataFrame) -> pd.DataFrame:
        partials = partials.sort_values("_task", ignore_index=True)
        values = partials[[str(k) for k in range(shards)]].to_numpy()
        at = difference([[int(x) for x in row] for row in values])
        return pd.DataFrame(
            {
                "_task": partials["_task"].repeat(shards).to_numpy(),
                "_part": list(range(shards)) * len(partials),
                "_above": partials["_above"].repeat(shards).to_numpy(),
                "_at": [p for own in at for p in own],
                "_bytes": values.reshape(-1),
            }
        )

    return combine


def shard(
    documents: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    groups_per_task: int = GROUPS_PER_TASK,
    carry: bool = False,
    partials_at_once: int = PARTIALS,
) -> DataFrame:
    """identifier, size, text_crc32, shard and slot of every row (with `carry`, all columns too).

    Size is the text's UTF-8 bytes plus one. Rows of equal text (null texts too) are one group and
    stay together. Groups' bytes are summed before the shuffle, dealt to tasks by hash and
    differenced there; each task leaves one partial partition, and those, a row of `shards` sums a
    task, are differenced once more in the same way, which is the method's own way of combining: in tasks, level
    by level, until `partials_at_once` are left. Only these meet in one place. Shards come out near equal unless a single group is larger than a
    shard. Rows find their group's shard by a join that is split by size where a group is hot.

    Slots are gapless from 0 in each shard, by a hash of the identifier, then the identifier.
    With `carry` a column named like one of the result's is handed on as `<name>_carried`.
    An empty text has size 1; so has a null one, with crc32 of no bytes; repeated rows are
    rows; an empty table gives no rows.
    """
    blob = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = documents.select(
        F.col(identifier).alias("_id"),
        (F.length(blob) + 1).cast("long").alias("size"),
        F.crc32(blob).alias("text_crc32"),
        F.when(F.col(text).isNull(), "").otherwise(F.md5(blob)).alias("_key"),
        *([F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")] if carry else []),
    )
    groups = written(rows.groupBy("_key").agg(F.sum("size").alias("_bytes")), "groups")
    tasks = max(1, -(-groups.count() // groups_per_task))
    dealt = groups.withColumn("_task", F.pmod(F.xxhash64("_key"), F.lit(tasks)).cast("int"))
    placed = written(
        dealt.groupBy("_task").applyInPandas(_by_task(shards), "_key string, _bytes long, _task int, _part int"), "placed"
    )
    shard_of = placed.select("_key", "_task", "_part")
    sums = placed.groupBy("_task", "_part").agg(F.sum("_bytes").alias("_bytes"))
    while tasks > partials_at_once:
        # Partial partitions of some tasks are differenced in a task of the next level.
        tasks = -(-tasks // partials_at_once)
        wide = _wide(sums, shards).withColumn("_above", F.pmod(F.xxhash64("_task"), F.lit(tasks)).cast("int"))
        moved = written(
            wide.groupBy("_above").applyInPandas(_by_level(shards), "_task int, _part int, _above int, _at int, _bytes long"), "moved"
        )
        up = moved.select("_task", "_part", "_above", "_at")
        shard_of = shard_of.join(up, ["_task", "_part"]).select("_key", F.col("_above").alias("_task"), F.col("_at").alias("_part"))
        sums = moved.groupBy(F.col("_above").alias("_task"), F.col("_at").alias("_part")).agg(F.sum("_bytes").alias("_bytes"))
    partials = sorted(tuple(r) for r in _wide(sums, shards).collect())
    final = difference([list(p[1:]) for p in partials])
    moves = [(p[0], part, at) for p, own in zip(partials, final) for part, at in enumerate(own)]
    moves = documents.sparkSession.createDataFrame(moves, "_task int, _part int, shard int")
    shard_of = shard_of.join(moves, ["_task", "_part"]).select("_key", "shard")
    located = rows.join(shard_of, "_key").withColumn("_chunk", F.pmod(F.xxhash64("_id"), F.lit(SLOT_CHUNKS)))
    ranked = gapless(located, ["shard"], ["_chunk"], ["_id", "_key"], "slot")
    taken = {c.lower() for c in (identifier, *RESULT)}
    kept = []
    for c in documents.columns if carry else []:
        if c != identifier:
            name = c
            while name.lower() in taken or name != c and name in documents.columns:
                name += "_carried"
            kept.append(F.col(f"_row.`{c}`").alias(name))
    return ranked.select(F.col("_id").alias(identifier), *kept, "size", "text_crc32", "shard", F.col("slot").cast("long"))
