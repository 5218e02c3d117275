"""N-gram Jaccard self-join by T-occurrence search (DivideSkip)."""

import heapq
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from obsmill.llm.shared import LOWER, components, matching, rolled
from obsmill.sinks.paths import written

WIDTH = 5
#: Least similarity, as a fraction of whole numbers: 100 * common >= 75 * union.
PART, WHOLE = 75, 100
#: Share by which the signature is longer than it must be, so that it can ask for more in common.
EXTRA = 0.1
#: Bits of a shingle in the signatures; fewer bits only let more documents through.
SIGNATURE_BITS = 44
#: Shingles of one chunk of a candidate group; larger groups are searched chunk against chunk.
CHUNK = 400_000


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit shingles of the whole text; fewer words than `width` make one."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < width:
        return rolled(np.append(hashed, np.uint64(len(words))), len(words) + 1)
    return np.unique(rolled(hashed, width))


def least_common(n: int) -> int:
    """Shingles that a set of n shares with any set it links with."""
    return -(-PART * n // WHOLE)


def _set_id(found: np.ndarray) -> int | None:
    """A 64-bit name of a set of shingles; null for the empty set, which links with nothing."""
    if not len(found):
        return None
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def signatures(documents: DataFrame, identifier: str, text: str, width: int) -> DataFrame:
    """(_id, n, set_id, needed, signature): the least shingles of each set.

    A set of n shares `least_common(n)` shingles with any set it links with, whatever their order;
    so of its first n - least_common(n) + k shingles in a common order at least k are shared.
    """
    rows = documents.select(F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    schema = T.StructType(
        [
            rows.schema["_id"],
            T.StructField("n", T.LongType()),
            T.StructField("set_id", T.LongType()),
            T.StructField("needed", T.IntegerType()),
            T.StructField("signature", T.ArrayType(T.LongType())),
        ]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [shingles(t, width) for t in part.column(1).to_pylist()]
                needed = [1 + int(EXTRA * len(s)) for s in sets]
                firsts = [s[: len(s) - least_common(len(s)) + k] >> np.uint64(64 - SIGNATURE_BITS) for s, k in zip(sets, needed)]
                ends = np.concatenate([[0], np.cumsum([len(f) for f in firsts])])
                flat = np.concatenate([*firsts, np.zeros(0, np.uint64)]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_set_id(s) for s in sets], pa.int64()),
                        pa.array(needed, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                    ],
                    names=schema.fieldNames(),
                )

    return rows.mapInArrow(sign, schema)


def _survivors(signed: DataFrame) -> DataFrame:
    """_id of the rows whose signature has enough shingles that another row's has too."""
    posted = signed.filter("n > 0").select("_id", F.explode("signature").alias("s"))
    shared = posted.groupBy("s").agg(F.count("*").alias("_rows")).filter("_rows > 1").select("s")
    found = posted.join(shared, "s").groupBy("_id").agg(F.count("*").alias("_shared"))
    needed = signed.filter("n > 0").groupBy(F.col("_id").alias("_own")).agg(F.min("needed").alias("needed"))
    return found.join(needed, F.col("_id").eqNullSafe(F.col("_own"))).filter("_shared >= needed").select("_id")


def _sets(documents: DataFrame, identifier: str, text: str, width: int, wanted: DataFrame) -> DataFrame:
    """(set_id, n, shingles) of the wanted rows, each set once; texts stay where they are read.

    Only rows that repeat an identifier can give a set twice, so sets are shuffled only where one does.
    """
    key = F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("_key")
    rows = documents.select(F.col(identifier).alias("_id"), F.col(text).alias("_text")).select(key, "_text")
    keys = written(wanted.select(key).distinct(), "wanted")
    chosen = matching(rows, keys, "_key")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                sets = [shingles(t, width) for t in batch.column(0).slice(at, 1000).to_pylist()]
                sets = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_set_id(s) for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["set_id", "n", "shingles"],
                )

    sets = written(chosen.select("_text").mapInArrow(cut, "set_id long, n long, shingles array<long>"), "sets")
    repeated = sets.groupBy("set_id").agg(F.count("*").alias("_rows")).filter("_rows > 1").head(1)
    return written(sets.dropDuplicates(["set_id"]), "sets") if repeated else sets


def _candidates(sets: DataFrame) -> DataFrame:
    """(set_id, node): sets that a chain of shared rare shingles joins have one node.

    Shingles that one set alone has can't be common; a set without `least_common` others is out.
    Of the rest the rarest come first: among its first n - least_common(n) + 1, the lone ones
    counted, a set shares one with each set it links with. Sets are hung on the least set of each
    such shingle, a row a set and shingle, never on each other.
    """
    posted = sets.select("set_id", "n", F.explode("shingles").alias("s"))
    rated = posted.groupBy("s").agg(F.count("*").alias("_sets")).filter("_sets > 1")
    own = (
        posted.join(rated, "s")
        .groupBy("set_id", "n")
        .agg(F.sort_array(F.collect_set(F.struct("_sets", "s"))).alias("_shared"))
    )
    least = F.expr(f"cast(ceil({PART} * n / {WHOLE}) as int)")
    lone = F.col("n") - F.size("_shared")
    first = F.slice("_shared", 1, F.greatest(F.lit(0), (F.col("n") - least + 1 - lone).cast("int")))
    rare = (
        own.filter(F.size("_shared") >= least)
        .select("set_id", F.explode(F.transform(first, lambda x: x["s"])).alias("s"))
    )
    rare = written(rare, "rare")
    hubs = rare.groupBy("s").agg(F.min("set_id").alias("hub"), F.count("*").alias("_sets")).filter("_sets > 1")
    edges = rare.join(hubs, "s").select("set_id", "hub").distinct()
    return components(edges, "set_id", "hub").select(F.col("node").alias("set_id"), F.col("root").alias("group"))


def _merged(runs: list[tuple[int, int]], owner: list[int], need: int, end: int, passed: Callable[[int], int]) -> Iterator[tuple[int, int]]:
    """(set, lists) of every set below `end` that at least `need` of the inverted lists `runs` hold.

    A heap has the next entry of each list. Lists that hold its top are popped together; where they
    are too few, `need` - 1 lists are popped in all and leap by binary search to what is then the
    top, for no set before that can be in enough lists. `passed` gives the first set from the top on
    that is still wanted.
    """
    heap = [(owner[at], at, stop) for at, stop in runs]
    heapq.heapify(heap)
    while len(heap) >= need and heap[0][0] < end:
        top = heap[0][0]
        target = passed(top)
        popped = []
        if target > top:
            while heap and heap[0][0] < target:
                popped.append(heapq.heappop(heap))
        else:
            while heap and heap[0][0] == top:
                popped.append(heapq.heappop(heap))
            if len(popped) >= need:
                yield top, len(popped)
                target = top + 1
            else:
                while heap and len(popped) < need - 1:
                    popped.append(heapq.heappop(heap))
                if not heap:
                    return
                target = heap[0][0]
        for _, at, stop in popped:
            at = bisect_left(owner, target, at, stop)
            if at < stop:
                heapq.heappush(heap, (owner[at], at, stop))


def divide_skip(queries: list[np.ndarray], index: list[np.ndarray], same: bool) -> list[tuple[int, int]]:
    """Links between `queries` and `index` that join what no link joined before.

    An inverted list a shingle, in order of set. For a query with T = `least_common`, its longest
    lists (DivideSkip's balance of merging against probing) are set aside; the short ones are merged
    by a heap, and a set met T - (long lists) times there is probed in the long ones by binary
    search. Sets that links have already joined with the query are leapt over: they'd join nothing
    new.
    """
    sizes = np.array([len(s) for s in index])
    flat = np.concatenate(index)
    order = np.argsort(flat, kind="stable")
    keys, begin, length = np.unique(flat[order], return_index=True, return_counts=True)
    owner = np.repeat(np.arange(len(index)), sizes)[order].tolist()
    nodes = list(range(len(index))) if same else list(range(len(index), len(index) + len(queries)))
    root = np.arange(len(index) + (0 if same else len(queries)))
    found = []
    for q, own in enumerate(queries):
        me, n, end = nodes[q], len(own), q if same else len(index)
        need = least_common(n)
        at = np.searchsorted(keys, own)
        hit = at < len(keys)
        hit[hit] = keys[at[hit]] == own[hit]
        at = at[hit]
        if len(at) < need:
            continue
        by_length = at[np.argsort(-length[at], kind="stable")]
        longest = int(length[by_length[0]])
        long = min(need - 1, int(need / (0.01 * math.log2(longest + 1) + 1)))
        runs = [(b, b + k) for b, k in zip(begin[by_length].tolist(), length[by_length].tolist())]
        apart: list[int] | None = None  # sets not joined with the query; all of them before its first link

        def passed(top: int) -> int:
            if apart is None:
                return top
            k = bisect_left(apart, top)
            return apart[k] if k < len(apart) else end

        for c, met in _merged(runs[long:], owner, need - long, end, passed):
            size = int(sizes[c])
            if WHOLE * min(size, n) < PART * max(size, n):
                continue
            least = -(-PART * (n + size) // (PART + WHOLE))
            for k, (first, stop) in enumerate(reversed(runs[:long])):
                if met >= least or met + long - k < least:
                    break
                place = bisect_left(owner, c, first, stop)
                met += place < stop and owner[place] == c
            if met >= least:
                found.append((me, c))
                root[root == root[me]] = root[c]
                apart = np.flatnonzero(root[:end] != root[me]).tolist()
    return found


def _search(pair: pd.DataFrame) -> pd.DataFrame:
    """Links of one chunk with another (or itself)."""
    pair = pair.sort_values(["_side", "set_id"], ignore_index=True)
    sets = [np.asarray(s).view(np.uint64) for s in pair["shingles"]]
    ids, side = pair["set_id"].to_numpy(), pair["_side"].to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if pair["_low"].iloc[0] == pair["_high"].iloc[0]:
        links = [(left[a], left[b]) for a, b in divide_skip([sets[k] for k in left], [sets[k] for k in left], True)]
    elif not len(left) or not len(right):
        links = []
    else:
        every = np.concatenate([left, right])
        links = [(every[a], left[b]) for a, b in divide_skip([sets[k] for k in right], [sets[k] for k in left], False)]
    return pd.DataFrame({"a": [int(ids[a]) for a, _ in links], "b": [int(ids[b]) for _, b in links]}, dtype="int64")


def near_duplicates(
    documents: DataFrame, identifier: str = "doc_id", text: str = "text", width: int = WIDTH, chunk: int = CHUNK
) -> DataFrame:
    """identifier, n_shingles and component_id of every row.

    Sets of `width`-word shingles link when 100 * common >= 75 * union; a component is all that
    links reach, named by its least identifier. No step drops a link: (1) signatures of each set
    leave out rows that can't link; (2) equal sets become one; (3) sets that share a rare shingle
    fall in one candidate group; (4) each group is searched by `divide_skip`, a group of more than
    `chunk` shingles chunk against chunk; (5) links, at most one a set and search, give the
    components. Work in (4) grows with the square of a group's chunks, not of its rows, and only
    distinct sets count: exact copies are one set from (2) on.

    Rows without words have no shingles, link with nothing and are their own component. Null
    identifiers never name a component unless it has no other. Rows are told apart by their set,
    so rows that repeat an identifier keep their own sets. An empty table gives no rows.
    """
    return _components(documents, identifier, text, width, chunk).select(
        F.col("_id").alias(identifier),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("_name")).otherwise(F.col("_id")).alias("component_id"),
    )


def _components(documents: DataFrame, identifier: str, text: str, width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """(_id, n, set_id, root, _name) of every row: its set, and its component's least set and identifier."""
    signed = written(signatures(documents, identifier, text, width), "signed")
    members = signed.select("_id", "n", "set_id")
    alive = written(_survivors(signed), "alive")
    candidate = members.filter("n > 0").join(alive.withColumnRenamed("_id", "_a"), F.col("_id").eqNullSafe(F.col("_a")), "left_semi")
    first = candidate.groupBy("set_id").agg(F.min("_id").alias("_id")).select("_id").distinct()
    sets = _sets(documents, identifier, text, width, first)
    grouped = _candidates(sets)
    weights = sets.select("set_id", "n").join(grouped, "set_id")
    total = weights.groupBy("group").agg(F.sum("n").alias("_all"), F.count("*").alias("_sets")).filter("_sets > 1")
    parts = F.greatest(F.lit(1), F.ceil(F.col("_all") / chunk)).cast("int")
    placed = (
        weights.drop("n").join(total, "group")
        .withColumn("_parts", parts)
        .withColumn("_part", F.pmod(F.xxhash64("set_id"), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .select(
            "set_id", "group",
            F.least("_part", "_other").alias("_low"), F.greatest("_part", "_other").alias("_high"),
            (F.col("_part") > F.col("_other")).cast("int").alias("_side"),
        )
    )
    searched = sets.select("set_id", "shingles").join(placed, "set_id")
    links = searched.groupBy("group", "_low", "_high").applyInPandas(_search, "a long, b long")
    roots = components(links, "a", "b").select(F.col("node").alias("set_id"), "root")
    rooted = members.join(roots, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    names = rooted.filter("n > 0").groupBy("root").agg(F.min("_id").alias("_name"))
    return rooted.join(names, "root", "left")


def one_of_each(documents: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """`documents` without those whose component another row names; columns unchanged.

    One row of each component stays: of the rows with the naming identifier those of the least set,
    of these the least by text. Rows are told apart by identifier and set, so another text under
    the same identifier, or without one, stays or goes by its own component. Rows without words stay.

    Identifiers of which every row goes, or whose only row stays, need no look at the text. The
    rows of the others are cut again for their sets.
    """
    found = _components(documents, identifier, text)
    named = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))
    members = written(found.select(named(F.col("_id")).alias("_one_key"), "n", "set_id", "root", F.col("_id").eqNullSafe(F.col("_name")).alias("_names")), "members")
    chosen = members.filter("n > 0 and _names").groupBy("root").agg(F.min("set_id").alias("_chosen"))
    stays = (F.col("n") == 0) | (F.col("_names") & (F.col("set_id") == F.col("_chosen")))
    decided = written(members.join(chosen, "root", "left").select("_one_key", "set_id", stays.alias("_stays")), "decided")
    by_key = decided.groupBy("_one_key").agg(F.count("*").alias("_rows"), F.count_if("_stays").alias("_kept"))
    removed = written(by_key.filter("_kept = 0").select("_one_key"), "removed")
    kept = matching(documents.withColumn("_one_key", named(F.col(identifier))), removed, "_one_key", "left_anti")
    asked = written(by_key.filter("_kept > 0 and _rows > 1").select("_one_key"), "asked")
    if not asked.head(1):
        return kept.drop("_one_key")

    @F.pandas_udf("long")
    def set_of(texts: pd.Series) -> pd.Series:
        return pd.Series([_set_id(shingles(t)) for t in texts], dtype="Int64")

    gone = written(matching(decided.filter("not _stays"), asked, "_one_key").select("_one_key", F.col("set_id").alias("_one_set")).distinct(), "gone")
    repeated = matching(kept, asked, "_one_key").withColumn("_one_set", set_of(F.col(text)))
    repeated = matching(repeated, gone, ["_one_key", "_one_set"], "left_anti")
    order = Window.partitionBy("_one_key", "_one_set").orderBy(text)
    worded = repeated.filter("_one_set is not null").withColumn("_one_row", F.row_number().over(order)).filter("_one_row = 1")
    alone = matching(kept, asked, "_one_key", "left_anti")
    parts = [part.select(documents.columns) for part in (alone, repeated.filter("_one_set is null"), worded)]
    return parts[0].union(parts[1]).union(parts[2])
