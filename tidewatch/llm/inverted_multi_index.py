"""Nearest neighbours by inner product through an inverted multi-index.

Vectors get one component more, the root of (largest squared norm - own squared norm), which turns the largest inner
product into the least distance. Each half of a vector is quantised with its own codebook; a pair of codes is a cell.
A query sorts the centroids of both halves by distance and walks the pairs in the order of the summed distance with a
heap, until the cells it has met hold enough entries; these entries are reranked by the exact inner product.

Queries are dealt to blocks of about ``BLOCK_ROWS`` entries from neighbouring cells: a query goes once to each block that
holds a cell of its walk, with the list of these cells, and meets the block's entries in one matrix product, of which it
keeps the entries of its own cells. A cell with more entries is dealt over several blocks, which its queries all visit,
so copies of one vector do not fill a task. Queries come in slices of about ``SLICE_QUERIES``, and every slice meets the
blocks in tasks of its own. The codebooks are fitted on at most ``FIT_ROWS`` vectors in the order of a hash of their id;
every row is indexed.

How many entries a query reranks follows from the table: the exact neighbours of ``PROBES`` drawn vectors among all rows
are found in one pass, and the walk goes as far as it must to reach ``RECALL`` of them. On vectors without clusters that
is a large part of the table at any size.

Edge cases: vectors that are null, empty, zero, of another length than most, or that hold null or non-finite
components take no part, neither as queries nor as candidates; the same for null ids; rows that repeat an id are
candidates of their own and one query; a table with fewer candidates than ``k`` gives all of them that its walks reach; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.session import stage

FIT_ROWS = 16_384
ROUNDS = 12
BLOCK_ROWS = 4_000  # entries that a task holds at once
SLICE_QUERIES = 20_000  # queries that meet a block in one task, about
VISIT_ROWS = 128  # queries whose walks or scores a task holds at once
SHARE = 0.06  # share of all entries that a query reranks at least
PROBES, RECALL = 256, 0.95  # drawn vectors, and the share of their true neighbours that walks must reach


def codebook(points: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Centroids of one half: k-means from distinct points."""
    distinct = np.unique(points, axis=0)
    draw = np.random.default_rng(seed)
    centres = distinct[draw.permutation(len(distinct))[: min(size, len(distinct))]].copy()
    for _ in range(ROUNDS):
        own = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None]


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), dtype=np.int64)
    for i in range(0, len(points), 4096):
        out[i : i + 4096] = distances(points[i : i + 4096], centres).argmin(1)
    return out


def walk(first: np.ndarray, second: np.ndarray, entries: np.ndarray, enough: int) -> list[int]:
    """Cells in the order of the summed distance of their two centroids, until they hold ``enough`` entries."""
    one, two = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    a, b = np.sort(first).tolist(), np.sort(second).tolist()
    heap, cells, held, width = [(a[0] + b[0], 0, 0)], [], 0, len(second)
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = one[i] * width + two[j]
        if entries[cell]:
            cells.append(cell)
            held += int(entries[cell])
        # Each pair is reached once: down the first column, then along its row.
        if j == 0 and i + 1 < len(one):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        if j + 1 < len(two):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
    return cells


def _matrix(vectors: pd.Series, top: float) -> np.ndarray:
    x = np.array(vectors.tolist(), dtype=np.float64)
    return np.column_stack((x, np.sqrt(np.maximum(0.0, top - (x**2).sum(1)))))


def _assign(one: np.ndarray, two: np.ndarray, top: float):
    half = one.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = _matrix(batch["vector"], top)
                cell = nearest(x[:, :half], one) * len(two) + nearest(x[:, half:], two)
                yield pd.DataFrame({"vec_id": batch["vec_id"], "cell": cell, "vector": batch["vector"]})

    return run


def blocks_of(entries: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of every cell: neighbouring cells share a block of about ``size`` entries, a
    larger cell has blocks of its own."""
    first, pieces = np.zeros(len(entries), dtype=np.int64), np.ones(len(entries), dtype=np.int64)
    block, held = 0, 0
    for cell, n in enumerate(entries.tolist()):
        if held and held + n > size:
            block, held = block + 1, 0
        first[cell], pieces[cell] = block, max(1, -(-n // size))
        held += n
        if n > size:
            block, held = block + int(pieces[cell]), 0
    return first, pieces


def _visits(one: np.ndarray, two: np.ndarray, entries: np.ndarray, first: np.ndarray, pieces: np.ndarray, enough: int):
    """One row per query and block, with the cells that the query's walk reaches there."""
    half = one.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), VISIT_ROWS):
                part = batch.iloc[i : i + VISIT_ROWS]
                x = np.array(part["vector"].tolist(), dtype=np.float64)
                x = np.column_stack((x, np.zeros(len(x))))
                to_one, to_two = distances(x[:, :half], one), distances(x[:, half:], two)
                rows = []
                for j, (query, vector) in enumerate(zip(part["vec_id"], part["vector"], strict=True)):
                    cells = np.sort(np.array(walk(to_one[j], to_two[j], entries, enough), dtype=np.int64))
                    cuts = np.flatnonzero(np.diff(first[cells])) + 1
                    for group in np.split(cells, cuts) if len(cells) else []:
                        block = int(first[group[0]])
                        rows += [(query, block + k, group, vector) for k in range(int(pieces[group[0]]))]
                yield pd.DataFrame(rows, columns=["query_id", "block", "cells", "vector"])

    return run


def _true(ids: np.ndarray, probes: np.ndarray, k: int):
    """The k best entries of a task for each probe, with their cells."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            for i in range(0, len(batch), 4096):
                part = batch.iloc[i : i + 4096]
                own = part["vec_id"].to_numpy()
                scores = probes @ np.array(part["vector"].tolist(), dtype=np.float64).T
                scores[ids[:, None] == own[None]] = -np.inf
                new = scores, np.tile(own, (len(ids), 1)), np.tile(part["cell"].to_numpy(), (len(ids), 1))
                held = new if held is None else tuple(np.concatenate(x, axis=1) for x in zip(held, new, strict=True))
                order = np.lexsort((held[1], -held[0]), axis=1)[:, :k]
                held = tuple(np.take_along_axis(x, order, axis=1) for x in held)
        if held is not None:
            probe = np.repeat(np.arange(len(ids)), held[0].shape[1])
            done = pd.DataFrame({"probe": probe, "score": held[0].ravel(), "vec_id": held[1].ravel(), "cell": held[2].ravel()})
            yield done[done["score"] > -np.inf]

    return run


def entries_needed(index: DataFrame, one: np.ndarray, two: np.ndarray, entries: np.ndarray, k: int) -> int:
    """Entries that a walk must hold so that the probes' walks reach ``RECALL`` of their true neighbours."""
    drawn = _drawn(index, int(entries.sum()), 1, PROBES).drop_duplicates("vec_id")
    x = np.array(drawn["vector"].tolist(), dtype=np.float64)
    found = index.mapInPandas(_true(drawn["vec_id"].to_numpy(), x, k), "probe long, score double, vec_id long, cell long")
    order = Window.partitionBy("probe").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("probe", "cell").toPandas()
    half, x = one.shape[1], np.column_stack((x, np.zeros(len(x))))
    first, second = distances(x[:, :half], one), distances(x[:, half:], two)
    needed = []
    for probe, cells in best.groupby("probe")["cell"]:
        walked = np.argsort((first[probe][:, None] + second[probe][None]).ravel(), kind="stable")
        before = np.empty(len(walked), dtype=np.int64)
        before[walked] = np.cumsum(entries[walked]) - entries[walked]
        needed += (before[cells.to_numpy()] + 1).tolist()
    return int(np.sort(needed)[math.ceil(RECALL * len(needed)) - 1]) if needed else 0


def _rerank(k: int):
    """The k best entries of a block for each query, among those of the cells that its walk reached."""

    def run(key: tuple, queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        parts = [pd.DataFrame({c: pd.Series(dtype=t) for c, t in zip(columns, ("int64", "int64", "float64"), strict=True)})]
        if not len(queries) or not len(entries):
            return parts[0]
        # Ties go to the smaller ids, which come first.
        entries = entries.sort_values("vec_id", kind="stable")
        ids, x = entries["vec_id"].to_numpy(), np.array(entries["vector"].tolist(), dtype=np.float64)
        cells, place = np.unique(entries["cell"].to_numpy(), return_inverse=True)
        for i in range(0, len(queries), VISIT_ROWS):
            part = queries.iloc[i : i + VISIT_ROWS]
            own = part["query_id"].to_numpy()
            reached = np.zeros((len(part), len(cells)), dtype=bool)
            for row, wanted in zip(reached, part["cells"], strict=True):
                row[np.isin(cells, wanted)] = True
            scores = np.array(part["vector"].tolist(), dtype=np.float64) @ x.T
            scores[~reached[:, place] | (ids[None] == own[:, None])] = -np.inf
            least = np.partition(scores, max(0, len(ids) - k), axis=1)[:, max(0, len(ids) - k)]
            row, at = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
            order = np.lexsort((at, -scores[row, at], row))
            row, at = row[order], at[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, at = row[best], at[best]
            parts.append(pd.DataFrame({"query_id": own[row], "vec_id": ids[at], "score": scores[row, at]}))
        return pd.concat(parts[1:], ignore_index=True)

    return run


def _drawn(rows: DataFrame, n: int, seed: int, wanted: int) -> pd.DataFrame:
    """The ``wanted`` rows with the least hashes; rows far above the cut are left out before any partition sends its own."""
    order = F.xxhash64("vec_id", F.lit(seed))
    if n > 2 * wanted:
        rows = rows.where(order < -(1 << 63) + (1 << 64) * 2 * wanted // n)
    return rows.orderBy(order, "vec_id").limit(wanted).toPandas()


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = embeddings.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & sound)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))


def neighbours(embeddings: DataFrame, k: int = 20, every: int = 20, share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query among all other rows."""
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    rows = rows.where(F.size("vector") == sizes["size"])
    norm = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    about = rows.agg(F.count("*").alias("n"), F.max(norm).alias("top")).first()
    n, top = about["n"], about["top"]
    fit = _drawn(rows, n, 0, FIT_ROWS)
    sample = _matrix(fit["vector"], top)
    half = sample.shape[1] // 2 or 1
    # About 50 entries a cell and never more centroids than a sixteenth of the sample.
    size = max(1, min(256, round(math.sqrt(n / 50)), max(1, len(sample) // 16)))
    one, two = codebook(sample[:, :half], size, 1), codebook(sample[:, half:], size, 2)
    index = stage(rows.mapInPandas(_assign(one, two, top), "vec_id long, cell long, vector array<double>"), "index")
    entries = np.zeros(len(one) * len(two), dtype=np.int64)
    for row in index.groupBy("cell").agg(F.count("*").alias("n")).collect():  # 65,536 cells at most
        entries[row["cell"]] = row["n"]
    first, pieces = blocks_of(entries, BLOCK_ROWS)
    enough = max(math.ceil(share * n), entries_needed(index, one, two, entries, k), k + 1)
    queries = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    slices = max(1, -(-queries.count() // SLICE_QUERIES))
    # 65,536 cells at most, as above.
    layout = spark.createDataFrame(pd.DataFrame({"cell": range(len(first)), "first": first, "pieces": pieces}))
    block = (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("pieces"))).cast("int").alias("block")
    dealt = index.join(F.broadcast(layout), "cell").select("vec_id", "cell", "vector", block, F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    schema = "query_id long, block int, cells array<long>, vector array<double>"
    visits = queries.mapInPandas(_visits(one, two, entries, first, pieces, enough), schema)
    visits = visits.withColumn("slice", F.pmod(F.xxhash64("query_id"), F.lit(slices)).cast("int"))
    met = visits.groupBy("block", "slice").cogroup(dealt.groupBy("block", "slice"))
    met = met.applyInPandas(_rerank(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
