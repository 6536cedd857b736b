"""Operator 11, exact top-k search by inner product as a Voronoi join.

Pivots, a bounded sample of the vectors, deal queries and data into cells: each vector goes to its nearest pivot. Cells are
told apart by summaries alone: of data, how many vectors a cell has and how far out its nearest few lie; of queries, their
largest product with each pivot and their largest norm. A product with x, of the cell of pivot p, lies within |q| |x - p| of
the product with p. So

* p's nearest few give every query K products that some vectors surely reach: the least that its K-th best can be, and
* a group of queries needs of each cell only the vectors that lie so far from its pivot that they might reach that.

Query cells are put together in groups of bounded size; data are sent to the groups that need them, dealt by slices, so
neither a hot vector nor a large cell fills a task; each slice is solved by itself, and the best of the slices are merged.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

K = 5
#: Vectors that serve as pivots, at most; what the driver holds is PIVOTS x dimensions and PIVOTS x PIVOTS numbers.
PIVOTS = 256
#: Queries of a group, at most; vectors of a slice on average; vectors whose products are held at once.
GROUP, SLICE, BLOCK = 1024, 1 << 16, 4096

SIDE = "vec_id bigint, cell int, dist double, v binary"


def scaled(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id long, v array<long>: floor(256 * x) of each component.

    Rows without an id, null vectors and those that hold a null or a component that is not finite are left out. Only vec_id
    and the vector are read.
    """
    x = F.transform(F.col(column).cast("array<double>"), lambda e: e * 256)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).filter("vec_id is not null and x is not null")
    # A null component makes forall null or false, either of which the filter drops.
    sound = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return rows.filter(sound).select("vec_id", F.transform("x", lambda e: F.floor(e)).alias("v"))


def _matrix(raws, width: int) -> np.ndarray:
    """Rows of integers, zeros after the end of shorter vectors."""
    out = np.zeros((len(raws), width), np.int64)
    for k, r in enumerate(raws):
        own = np.frombuffer(r, "<i8")
        out[k, : len(own)] = own
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of rows, exact: by floating point where no sum can pass 2**53, else by 64-bit integers."""
    if len(a) and len(b) and float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _raw(rows: DataFrame) -> DataFrame:
    """Vectors as bytes, 64-bit integers in a row."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            flat, ends = b.column(1).values.to_numpy(zero_copy_only=False), b.column(1).offsets.to_numpy()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([flat[x:y].astype("<i8").tobytes() for x, y in zip(ends[:-1], ends[1:])], pa.binary())], ["vec_id", "v"])

    return rows.mapInArrow(run, "vec_id bigint, v binary")


def pivots(rows: DataFrame, many: int = PIVOTS) -> np.ndarray:
    """The pivots, a matrix as wide as the longest vector: the different vectors whose hashes are least, at most so many."""
    width = common.collect(rows.agg(F.max(F.length("v"))))[0][0] or 0
    found = common.collect(rows.select("v").withColumn("h", F.xxhash64("v")).groupBy("h").agg(F.min("v").alias("v")).orderBy("h").limit(many))
    return _matrix([bytes(r.v) for r in found], width // 8)


def dealt(rows: DataFrame, at: np.ndarray) -> DataFrame:
    """Rows with the cell (number of the nearest pivot, the first of equals) and the distance to it."""
    import pyarrow as pa

    p = at.astype(np.float64)
    own = (p * p).sum(1)

    def run(batches):
        for b in common.sliced(batches, BLOCK):
            x = _matrix(b.column(1).to_pylist(), p.shape[1]).astype(np.float64)
            cell = (own - 2 * x @ p.T).argmin(1)
            dist = np.sqrt(((x - p[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cell, pa.int32()), pa.array(dist), b.column(1)], [c.split()[0] for c in SIDE.split(", ")])

    return rows.mapInArrow(run, SIDE)


def summaries(data: DataFrame, n: int, k: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of vectors; of each cell the distances (infinite where it has fewer) and ids of the k + 1 nearest of its pivot."""
    from pyspark.sql import Window

    near = data.select("cell", "dist", "vec_id").withColumn("r", F.row_number().over(Window.partitionBy("cell").orderBy("dist", "vec_id"))).filter(F.col("r") <= k + 1)
    dist, ids = np.full((n, k + 1), np.inf), np.zeros((n, k + 1), np.int64)
    for r in common.collect(near):
        dist[r.cell, r.r - 1], ids[r.cell, r.r - 1] = r.dist, r.vec_id
    return common.collect(data.agg(F.count("*")))[0][0], dist, ids


QUERY_CELLS = "cell int, n bigint, norm double, floor double, most binary"


def query_summaries(queries: DataFrame, at: np.ndarray, dist: np.ndarray, ids: np.ndarray, k: int) -> list:
    """Of each query cell: how many queries, their largest norm, their largest product with each pivot, and the floor.

    The floor is a product that the k-th best of each of the cell's queries reaches: a query's product with a pivot less its
    norm times the distance is reached by each of the pivot's nearest, and of these bounds, without those of the query's own
    id, the k-th counts. Partitions give a row a cell, folded by cell; the driver gets a row a cell.
    """
    import pyarrow as pa

    p = at.astype(np.float64)
    names = [c.split()[0] for c in QUERY_CELLS.split(", ")]

    def table(cells, n, norm, floor, most):
        return pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(n, pa.int64()), pa.array(norm, pa.float64()), pa.array(floor, pa.float64()), pa.array([m.tobytes() for m in most], pa.binary())], names)

    def run(batches):
        n, norm, floor, most = np.zeros(len(p), np.int64), np.zeros(len(p)), np.full(len(p), np.inf), np.full((len(p), len(p)), -np.inf)
        for b in common.sliced(batches, 256):
            x = _matrix(b.column(3).to_pylist(), p.shape[1]).astype(np.float64)
            cell, own, size, own_id = b.column(1).to_numpy(), x @ p.T, np.sqrt((x * x).sum(1)), b.column(0).to_numpy()
            usable = np.isfinite(dist)[None] & (ids[None] != own_id[:, None, None])
            reach = np.where(usable, own[:, :, None] - size[:, None, None] * np.where(np.isfinite(dist), dist, 0)[None], -np.inf).reshape(len(x), -1)
            low = np.partition(reach, reach.shape[1] - k, axis=1)[:, reach.shape[1] - k] if reach.shape[1] >= k else np.full(len(x), -np.inf)
            np.add.at(n, cell, 1)
            np.maximum.at(norm, cell, size)
            np.minimum.at(floor, cell, low)
            np.maximum.at(most, cell, own)
        cells = np.flatnonzero(n)
        yield table(cells, n[cells], norm[cells], floor[cells], most[cells])

    def fold(batches):
        held: dict = {}
        for b in batches:
            for cell, a, c, d, e in zip(*(b.column(i).to_pylist() for i in range(5))):
                n, norm, floor, most = held.get(cell, (0, 0.0, np.inf, -np.inf))
                held[cell] = n + a, max(norm, c), min(floor, d), np.maximum(most, np.frombuffer(e))
        yield table(list(held), *(list(x) for x in zip(*held.values()))) if held else table([], [], [], [], [])

    return common.collect(queries.select(*[c.split()[0] for c in SIDE.split(", ")]).mapInArrow(run, QUERY_CELLS).repartition("cell").mapInArrow(fold, QUERY_CELLS))


def grouped(cells: list, at: np.ndarray) -> dict[int, list]:
    """Query cells put together, from each the nearest next: at most GROUP queries a group, but for a cell that alone has more."""
    left = {c.cell: c for c in cells}
    groups, p = {}, at.astype(np.float64)
    while left:
        first = max(left.values(), key=lambda c: (c.n, -c.cell))
        near = sorted(left, key=lambda c: (((p[c] - p[first.cell]) ** 2).sum(), c))
        own, size = [], 0
        for c in near:
            if not own or size + left[c].n <= GROUP:
                own.append(left.pop(c))
                size += own[-1].n
        groups[len(groups)] = own
    return groups


def needed(groups: dict[int, list], n: int) -> np.ndarray:
    """For each group and data cell the least distance from the pivot at which a vector may be among a query's best."""
    out = np.full((len(groups), n), np.inf)
    for g, own in groups.items():
        for c in own:
            gap = c.floor - np.frombuffer(c.most)
            slack = 1e-6 * (1 + np.abs(gap) + abs(c.floor if np.isfinite(c.floor) else 0))
            with np.errstate(divide="ignore", invalid="ignore"):
                least = np.where(gap - slack <= 0, 0.0, (gap - slack) / c.norm)
            out[g] = np.minimum(out[g], least)
    return out


#: Stands for the product of a query with its own id, which is no candidate.
OWN = np.iinfo(np.int64).min


def best(products: np.ndarray, ids: np.ndarray, own: np.ndarray, held: tuple[np.ndarray, np.ndarray, np.ndarray], k: int):
    """The k best of those held (query's row, score, id; k a query at most) and a block of products, per query; own: the queries' ids."""
    row, score, vec = held
    for j in np.flatnonzero(np.isin(ids, own)).tolist():
        products[own == ids[j], j] = OWN
    least = np.full(len(own), OWN + 1)
    worst = np.full(len(own), np.iinfo(np.int64).max)
    np.minimum.at(worst, row, score)
    full = np.bincount(row, minlength=len(own)) >= k
    least[full] = worst[full]
    if products.shape[1] >= k:
        least = np.maximum(least, np.partition(products, products.shape[1] - k, axis=1)[:, products.shape[1] - k])
    i, j = np.nonzero(products >= least[:, None])
    row, score, vec = np.concatenate([row, i]), np.concatenate([score, products[i, j]]), np.concatenate([vec, ids[j]])
    order = np.lexsort((vec, -score, row))
    row, score, vec = row[order], score[order], vec[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], score[keep], vec[keep]


SENT = "grp int, slice int, query bigint, vec_id bigint, v binary"


def _asked(cells: DataFrame, groups: dict[int, list], blocks: list[int], slices: int) -> DataFrame:
    """Each query in its block of its group, once for each slice."""
    import pyarrow as pa

    first = np.cumsum([0, *blocks])
    of = {c.cell: g for g, own in groups.items() for c in own}

    def run(batches):
        for b in common.sliced(batches, BLOCK):
            query = b.column(4)
            grp = np.array([first[of[c]] + q % blocks[of[c]] for c, q in zip(b.column(1).to_pylist(), query.to_pylist())], np.int32)
            for x in range(slices):
                yield pa.RecordBatch.from_arrays([pa.array(grp), pa.array(np.full(len(grp), x, np.int32)), query, b.column(0), b.column(3)], [c.split()[0] for c in SENT.split(", ")])

    return cells.mapInArrow(run, SENT)


def _given(cells: DataFrame, least: np.ndarray, blocks: list[int], slices: int) -> DataFrame:
    """Each vector in a slice of the groups that may need it, once for each block of queries."""
    import pyarrow as pa

    first = np.cumsum([0, *blocks])

    def run(batches):
        seen = 0
        for b in common.sliced(batches, BLOCK):
            cell, dist = b.column(1).to_numpy(), b.column(2).to_numpy()
            piece = (seen + np.arange(b.num_rows)) % slices  # by place in the partition, so that no value of any column is hot
            seen += b.num_rows
            for g, own in enumerate(least):
                at = pa.array(np.flatnonzero(dist >= own[cell]))
                if not len(at):
                    continue
                held = b.take(at)
                where = pa.array(piece[at.to_numpy()].astype(np.int32))
                for k in range(first[g], first[g + 1]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), where, pa.nulls(len(at), pa.int64()), held.column(0), held.column(3)], [c.split()[0] for c in SENT.split(", ")])

    return cells.mapInArrow(run, SENT)


FOUND = "query bigint, query_id bigint, vec_id bigint, score bigint"


def _solved(rows: DataFrame, width: int, k: int) -> DataFrame:
    """The best k of each slice for each of its queries. Rows: grp, slice, query (null: data), vec_id, v; queries come first."""
    import pyarrow as pa

    def run(batches):
        at, q, x, held, ready = None, [], [], None, None

        def solve():
            nonlocal x, held, ready
            if ready is None and q:
                ready = _matrix([r[2] for r in q], width), np.array([r[1] for r in q], np.int64), np.array([r[0] for r in q], np.int64)
                held = (np.zeros(0, np.int64),) * 3
            if ready is not None and x:
                held = best(_product(ready[0], _matrix([r[1] for r in x], width)), np.array([r[0] for r in x], np.int64), ready[1], held, k)
            x = []

        def out():
            solve()
            row, score, vec = held if held is not None else (np.zeros(0, np.int64),) * 3
            names, own = (ready[2], ready[1]) if ready is not None else (np.zeros(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(names[row]), pa.array(own[row]), pa.array(vec), pa.array(score)], [c.split()[0] for c in FOUND.split(", ")])

        for b in common.sliced(batches, BLOCK):
            for grp, piece, query, vec_id, v in zip(*(b.column(i).to_pylist() for i in range(5))):
                if (grp, piece) != at:
                    if at is not None:
                        yield out()
                    at, q, x, held, ready = (grp, piece), [], [], None, None
                if query is not None:
                    q.append((query, vec_id, v))
                else:
                    x.append((vec_id, v))
                    if len(x) == BLOCK:
                        solve()
        if at is not None:
            yield out()

    return rows.repartition("grp", "slice").sortWithinPartitions("grp", "slice", F.col("query").asc_nulls_last()).select("grp", "slice", "query", "vec_id", "v").mapInArrow(run, FOUND)


def search(queries: DataFrame, data: DataFrame, k: int = K, column: str = "embedding") -> DataFrame:
    """Each query's k best by product, ties to smaller vec_id: query_id, rank int (from 1), vec_id, score long.

    Exact. A query's own vec_id is no candidate; a query with fewer candidates has fewer rows. Rows that take no part are as
    in scaled(); a shorter vector counts as if zeros followed. Queries equal in id and vector are one query; data rows
    repeated as a whole are candidates each. Queries of one id and different vectors are searched for each by itself and
    all have ranks from 1. Either table empty: no rows. Columns other than vec_id and the vector are not read. Products are
    exact below 2**63.
    """
    from pyspark.sql import Window

    spark = data.sparkSession
    cols = "query_id bigint, rank int, vec_id bigint, score bigint"
    rows = common.keep(_raw(scaled(data, column)), "vectors")
    asked = common.keep(_raw(scaled(queries, column)).distinct(), "asked")
    at = pivots(rows)
    if not len(at) or common.is_empty(asked):
        return spark.createDataFrame([], cols)
    width = max(at.shape[1], (common.collect(asked.agg(F.max(F.length("v"))))[0][0] or 0) // 8)
    at = np.pad(at, ((0, 0), (0, width - at.shape[1])))
    data_cells = common.keep(dealt(rows, at), "data-cells")
    query_cells = common.keep(dealt(asked, at).withColumn("query", F.monotonically_increasing_id()), "query-cells")
    common.drop(rows)
    common.drop(asked)
    total, dist, ids = summaries(data_cells, len(at), k)
    groups = grouped(query_summaries(query_cells, at, dist, ids, k), at)
    blocks = [-(-sum(c.n for c in own) // GROUP) for own in groups.values()]
    slices = max(1, -(-total // SLICE), -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // sum(blocks)))
    ask = _asked(query_cells, groups, blocks, slices)
    give = _given(data_cells, needed(groups, len(at)), blocks, slices)
    found = _solved(ask.union(give), width, k)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def digest(vectors: DataFrame) -> DataFrame:
    """search() for the rows whose vec_id is divisible by 50, among all rows, by five. What takes no part is as there."""
    return search(vectors.filter("vec_id % 50 = 0"), vectors)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.v::DOUBLE[], x.v::DOUBLE[])::BIGINT AS score FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
