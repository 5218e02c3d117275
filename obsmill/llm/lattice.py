"""Near-duplicate vectors by E8 lattice hashing."""

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from obsmill.llm.shared import components, mixed
from obsmill.sinks.paths import written

COSINE = 0.93
TABLES = 8
#: E8 blocks of a cell; each takes eight projections.
BLOCKS = 2
#: Neighbouring cells probed in each table.
PROBES = 3
#: Length that a lattice step has in projected space.
STEP = 2.0
SEED = 8
#: Vectors of one part of a cell; fuller cells are compared part against part.
PART = 1_500
#: Rows of one task's bucket of cells, on average.
BUCKET = 20_000


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The E8 point nearest to each row of 8: the better of D8 and D8 + 1/2."""

    def d8(y: np.ndarray) -> np.ndarray:
        f = np.rint(y)
        odd = np.flatnonzero(f.sum(axis=-1) % 2)
        off = y[odd] - f[odd]
        k = np.abs(off).argmax(axis=-1)
        f[odd, k] += np.where(off[np.arange(len(odd)), k] >= 0, 1, -1)
        return f

    whole, half = d8(x), d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=-1) < ((x - whole) ** 2).sum(axis=-1)
    return np.where(closer[:, None], half, whole)


def _shortest() -> np.ndarray:
    """The 240 shortest lattice vectors: steps to the neighbouring points."""
    pairs = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            pairs.append(v)
    halves = [np.array(s) / 2 for s in itertools.product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(pairs + halves)


NEIGHBOURS = _shortest()


def cells(vectors: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> tuple[np.ndarray, np.ndarray]:
    """(home, probed): by vector and table the cell it lies in, and the nearest neighbouring cells.

    `vectors` have length one. A cell is the lattice points of `BLOCKS` blocks of random
    projections, hashed with the table's number. A probe moves one block to a neighbouring point;
    those nearest to the projection come first.
    """
    n, dims = vectors.shape
    draw = np.random.default_rng(SEED)
    weights = mixed(draw.integers(1, 1 << 62, 8 * BLOCKS).astype(np.uint64)) | np.uint64(1)
    home = np.zeros((n, tables), np.uint64)
    probed = np.zeros((n, tables, probes), np.uint64)
    for t in range(tables):
        lines = draw.standard_normal((8 * BLOCKS, dims)) / STEP
        shift = draw.random(8 * BLOCKS)
        x = vectors @ lines.T + shift
        points = np.concatenate([nearest_e8(x[:, 8 * b : 8 * b + 8]) for b in range(BLOCKS)], axis=1)
        doubled = (2 * points).astype(np.int64).view(np.uint64)
        total = (doubled * weights).sum(axis=1, dtype=np.uint64) + np.uint64(t)
        home[:, t] = mixed(total)
        gain, steps = [], []
        for b in range(BLOCKS):
            part = slice(8 * b, 8 * b + 8)
            gain.append((x[:, part] - points[:, part]) @ NEIGHBOURS.T)
            steps.append(((2 * NEIGHBOURS).astype(np.int64).view(np.uint64) * weights[part]).sum(axis=1, dtype=np.uint64))
        gain, steps = np.concatenate(gain, axis=1), np.concatenate(steps)
        best = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
        probed[:, t] = mixed(total[:, None] + steps[best])
    return home, probed


def unit(vectors: list[list[float]]) -> np.ndarray:
    x = np.array(vectors, dtype=np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _classes(embeddings: DataFrame, identifier: str, vector: str, label: str) -> DataFrame:
    """(node, label, dims, vector, copies): distinct valid vectors of a label; node names the class."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    rows = embeddings.select(
        F.col(identifier).alias("_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    valid = F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("_valid", F.coalesce(valid, F.lit(False)))
    own = F.xxhash64(F.lit(1), "label", "vector")
    return rows.withColumn("node", F.when(F.col("_valid"), own))


def _links(own: np.ndarray, group: dict[str, np.ndarray], x: np.ndarray, home: np.ndarray, probed: np.ndarray, threshold: float):
    """Pairs of rows of one cell's part (or two parts) that link and that this cell is the first to show."""
    side, at_home, ids = group["_side"][own], group["at_home"][own], group["node"][own]
    table, cell = int(group["table"][own[0]]), group["cell"][own[0]]
    if not at_home.any():
        return own[:0], own[:0]
    within = group["_low"][own[0]] == group["_high"][own[0]]
    rows, columns = (np.arange(len(own)),) * 2 if within else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    near = x[own[rows]] @ x[own[columns]].T >= threshold - 1e-9
    if within:
        near &= np.tri(len(own), k=-1, dtype=bool)
    i, j = np.nonzero(near)
    a, b = rows[i], columns[j]
    # Where the cosine is so near the threshold that the order of sums counts, it is summed plainly.
    shown = ((x[own[a]] * x[own[b]]).sum(axis=1) >= threshold) & (at_home[a] | at_home[b])
    a, b = a[shown], b[shown]
    a_least = ids[a] < ids[b]
    first = np.ones(len(a), bool)
    p, q = own[a], own[b]
    for t in range(table + 1):
        both = home[p, t] == home[q, t]
        ab = (probed[q, t] == home[p, t][:, None]).any(axis=1)
        ba = (probed[p, t] == home[q, t][:, None]).any(axis=1)
        if t < table:
            first &= ~(both | ab | ba)
        else:
            # In one table: the shared home, else the home of the lesser node, else the other's.
            lesser = np.where(a_least, home[p, t], home[q, t])
            other = np.where(a_least, home[q, t], home[p, t])
            first &= cell == np.where(both | np.where(a_least, ab, ba), lesser, other)
    return p[first], q[first]


def _search(threshold: float, tables: int, probes: int):
    """Counts of links and a spanning forest of them, for a bucket of cells' parts."""

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["label", "table", "cell", "_low", "_high", "_side", "node"], ignore_index=True)
        group = {c: frame[c].to_numpy() for c in ("node", "table", "_low", "_high", "_side", "at_home", "copies")}
        group["cell"] = frame["cell"].to_numpy().view(np.uint64)
        label = frame["label"].to_numpy()
        x = unit(frame["vector"].tolist())
        home, probed = cells(x, tables, probes)
        same = label[1:] == label[:-1]
        for c in ("table", "cell", "_low", "_high"):
            same &= group[c][1:] == group[c][:-1]
        starts = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(frame)]])
        counts = np.zeros(len(frame), np.int64)
        root = np.arange(len(frame))

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        edges = []
        for begin, end in zip(starts[:-1], starts[1:]):
            if end - begin < 2:
                continue
            a, b = _links(np.arange(begin, end), group, x, home, probed, threshold)
            np.add.at(counts, a, group["copies"][b])
            np.add.at(counts, b, group["copies"][a])
            for p, q in zip(a.tolist(), b.tolist()):
                p, q = top(p), top(q)
                if p != q:
                    root[p] = q
                    edges.append((group["node"][p], group["node"][q]))
        linked = np.flatnonzero(counts)
        return pd.DataFrame(
            {
                "node": np.concatenate([group["node"][linked], np.array([e[0] for e in edges], np.int64)]),
                "other": pd.array([None] * len(linked) + [e[1] for e in edges], dtype="Int64"),
                "links": np.concatenate([counts[linked], np.zeros(len(edges), np.int64)]),
            }
        )

    return search


def _buckets(counts: DataFrame, part: int) -> int:
    """Buckets for cells of `_all` rows each: a cell of several parts repeats its rows once for every part."""
    repeated = F.sum(F.col("_all") * F.ceil(F.col("_all") / part))
    return max(1, -(-(counts.agg(repeated).first()[0] or 0) // BUCKET))


def near_vectors(
    embeddings: DataFrame,
    identifier: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = COSINE,
    tables: int = TABLES,
    probes: int = PROBES,
    part: int = PART,
) -> DataFrame:
    """identifier, n_links, component_id and kept of every row.

    Vectors of equal label link when their cosine, in double precision, is `threshold` or more and
    a table shows them to each other: both in one lattice cell, or one in a cell that the other
    probes. Equal vectors of a label are one class with its copies counted, found by grouping.
    Cells are joined by (label, table, cell); a cell of more than `part` vectors is compared part
    against part, so no cell is cut short. A task gives counts and the links of a spanning forest.
    Cells of vectors with different numbers of components never meet.

    Vectors that are null, zero, empty or hold null or non-finite components, and those without a
    label, link with nothing. Null identifiers are rows but never name a component unless it has no
    other. Repeated rows are copies that link; an empty table gives no rows.
    """
    rows = _classes(embeddings, identifier, vector, label)
    members = rows.select("_id", "node")
    classes = written(
        rows.filter("_valid").groupBy("node", "label", "vector").agg(F.count("*").alias("copies")), "classes"
    )

    def hash_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                some = batch.slice(at, 2000)
                vectors = some.column("vector").to_pylist()
                by: dict[int, list[int]] = {}
                for k, v in enumerate(vectors):
                    by.setdefault(len(v), []).append(k)
                for chosen in by.values():
                    home, probed = cells(unit([vectors[k] for k in chosen]), tables, probes)
                    every = np.concatenate([home[:, :, None], probed], axis=2)
                    each = every.shape[1] * every.shape[2]
                    n = len(chosen)
                    node = np.asarray(some.column("node").take(pa.array(chosen)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(node, each)),
                            pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), 1 + probes), n)),
                            pa.array(every.reshape(-1).view(np.int64)),
                            pa.array(np.tile(np.arange(1 + probes) == 0, n * tables)),
                        ],
                        names=["node", "table", "cell", "at_home"],
                    )

    hashed = classes.select("node", "vector").mapInArrow(hash_cells, "node long, table int, cell long, at_home boolean")
    keyed = written(hashed.join(classes.select("node", "label", F.size("vector").alias("dims")), "node"), "cells")
    cell = ["label", "dims", "table", "cell"]
    # A cell without a home vector, or with one vector, shows nothing.
    counts = keyed.groupBy(*cell).agg(F.count("*").alias("_all"), F.max("at_home").alias("_home")).filter("_all > 1 and _home")
    parts = F.ceil(F.col("_all") / part).cast("int")
    buckets = _buckets(counts, part)
    placed = (
        keyed.join(counts, cell)
        .withColumn("_parts", parts)
        .withColumn("_part", F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .select(
            *cell, "node", "at_home",
            F.least("_part", "_other").alias("_low"), F.greatest("_part", "_other").alias("_high"),
            (F.col("_part") > F.col("_other")).cast("int").alias("_side"),
        )
    )
    bucket = F.pmod(F.xxhash64("label", "table", "cell", "_low", "_high"), F.lit(buckets)).alias("_bucket")
    filled = placed.join(classes.select("node", "vector", "copies"), "node").select("*", bucket)
    found = written(
        filled.groupBy("dims", "_bucket").applyInPandas(_search(threshold, tables, probes), "node long, other long, links long"),
        "links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("_links"))
    roots = components(found.filter("other is not null"), "node", "other").select("node", "root")
    own = classes.select("node", "copies").join(links, "node", "left").join(roots, "node", "left")
    joined = members.join(own, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = joined.filter("node is not null").groupBy("root").agg(F.min("_id").alias("_name"))
    component = F.when(F.col("node").isNotNull(), F.col("_name")).otherwise(F.col("_id"))
    return (
        joined.join(names, "root", "left")
        .select(
            F.col("_id").alias(identifier),
            (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("_links", F.lit(0))).cast("long").alias("n_links"),
            component.alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(identifier) == F.col("component_id"), F.lit(False)))
    )
