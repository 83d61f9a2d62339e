"""Near-duplicate vectors by product quantisation.

Coarse inverted lists and subspace codes of the residuals are fitted on a bounded sample; every vector is indexed, and every
vector is a query. A query probes its nearest lists; of two lists one asks the other. How many lists are enough is measured: a
bounded number of queries is compared with all vectors, and each link found tells the rank of the list in which it would have
been met; the probes are the least number that meets nearly all of them. With ``exact`` a query probes instead each list that a
link of the greatest length can reach, by bounds and no estimates (its bisector with the query's own list, and its radius), so
no link is lost, at the price of many more probes. Within a list, table look-ups give distances to the coded vectors, and all
within the link's length plus the vector's own coding error go on to an exact cosine in double precision. Lists are cut into
blocks of vectors and queries, so a hot list is many tasks; a task sends on link counts and a spanning forest, never the pairs.
Vectors of different lengths never link, so each length has lists of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_arrow, ship, written
from .components import components

SIMILARITY = 0.95
#: Rows that quantisers are fitted on: over all lengths, and of one length at least, if it has as many.
SAMPLE, LEAST_SAMPLE = 20_000, 512
#: Queries that recall is measured with (ids divisible by 100, in order of a hash), the recall aimed at, the fewest probes.
MEASURED, RECALL, PROBES = 1_000, 0.999, 16
#: Added to bounds on squared distances; far above the rounding of vectors of length 1.
SLACK = 1e-6
#: Vectors of the sample for each list.
A_LIST = 4
SUBSPACES, CODES = 8, 64
VECTORS_A_BLOCK, QUERIES_A_BLOCK = 2_000, 4_000


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre and squared distances to all."""
    d = np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1), 0)
    return d.argmin(1), d


def _centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly spread starting rows; empty clusters keep their place."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = _nearest(x, centres)[0]
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


class Quantiser:
    """Coarse centres and code books for vectors of one length, with the rule that picks the lists to probe."""

    def __init__(self, sample: np.ndarray, lists: int, similarity: float):
        self.centres = _centres(sample, lists)
        own = _nearest(sample, self.centres)[0]
        rest = sample - self.centres[own]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [_centres(rest[:, p], CODES, 5) for p in self.parts]
        self.reach = math.sqrt(2 - 2 * similarity)
        self.gaps = np.sqrt(_nearest(self.centres, self.centres)[1])

    def radii(self, unit: np.ndarray) -> np.ndarray:
        """Distance of the farthest of these vectors from the centre of each list; a vector between two lists counts in both."""
        d = _nearest(unit, self.centres)[1]
        return np.sqrt(np.where(d <= d.min(1)[:, None] + SLACK, d, 0).max(0, initial=0))

    def _asks(self, own: np.ndarray) -> np.ndarray:
        """Which lists vectors of these lists may ask; of two lists only one asks the other."""
        other = np.arange(len(self.centres))
        return (own[:, None] < other) ^ ((own[:, None] + other) % 2 == 1)

    def lists_and_probes(self, unit: np.ndarray, radii: np.ndarray | None, probes: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Own list of each vector, and for each list whether it has to be probed: all in reach by ``radii``, or the nearest ``probes``."""
        own, d = _nearest(unit, self.centres)
        rows = np.arange(len(d))
        if radii is None:
            asked = np.zeros(d.shape, bool)
            nearest = np.argpartition(d, min(probes, d.shape[1]) - 1, axis=1)[:, :probes]
            asked[rows[:, None], nearest] = True
        else:
            asked = d - d[rows, own][:, None] <= 2 * self.reach * self.gaps[own] + SLACK
            asked &= d <= (self.reach + radii) ** 2 + SLACK
        asked &= self._asks(own)
        asked[rows, own] = True
        return own, asked

    def ranks(self, queries: np.ndarray, unit: np.ndarray, similarity: float) -> np.ndarray:
        """For each link of a query with one of the vectors: the rank of the one's list among those nearest to the other, which asks."""
        at, to = np.nonzero(queries @ unit.T >= similarity)
        if not len(at):
            return np.empty(0, np.int64)
        (own, d), (home, e) = _nearest(queries, self.centres), _nearest(unit[np.unique(to)], self.centres)
        to = np.searchsorted(np.unique(to), to)
        asks = self._asks(own)[at, home[to]]
        there = (d[at] < d[at, home[to]][:, None]).sum(1)
        back = (e[to] < e[to, own[at]][:, None]).sum(1)
        return np.where(own[at] == home[to], 0, np.where(asks, there, back))

    def encode(self, unit: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals and the length of what they leave out."""
        rest = unit - self.centres[own]
        codes = np.empty((len(unit), len(self.parts)), np.uint8)
        for s, (p, book) in enumerate(zip(self.parts, self.books, strict=True)):
            codes[:, s] = _nearest(rest[:, p], book)[0]
            rest[:, p] -= book[codes[:, s]]
        return codes, np.sqrt((rest**2).sum(1))

    def distances(self, unit: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """From queries to coded vectors of one list, by one table of partial distances a query and subspace."""
        rest = unit - self.centres[which]
        total = np.zeros((len(unit), len(codes)))
        for s, (p, book) in enumerate(zip(self.parts, self.books, strict=True)):
            total += _nearest(rest[:, p], book)[1][:, codes[:, s]]
        return np.sqrt(total)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(len(column), -1).astype(float)


def _flat(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype("<f4").reshape(len(column), -1)


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each length of the vectors in the first column."""
    sizes = pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        yield int(size), batch.take(pa.array(np.flatnonzero(sizes == size)))


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x**2).sum(1))[:, None]


def spanning(link: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least id that each row and column of a block of links reaches inside the block."""
    far = np.iinfo(np.int64).max
    a, b = left.copy(), right.copy()
    while True:
        new_a = np.minimum(a, np.where(link, b[None, :], far).min(1, initial=far))
        new_b = np.minimum(b, np.where(link, new_a[:, None], far).min(0, initial=far))
        if (new_a == a).all() and (new_b == b).all():
            return a, b
        a, b = new_a, new_b


_NONE = pa.table({c: pa.array([], pa.int64()) for c in ("node", "links", "to")})


def _compare(which: int, vectors: pa.Table, queries: pa.Table, quantiser: Quantiser | None, similarity: float) -> pa.Table:
    """For each vector with links in this block: their number (counting copies) and a node of the same component."""
    if not len(vectors) or not len(queries):
        return _NONE
    numbers = lambda table, name: table.column(name).to_numpy()
    x, ids, copies = _units(_matrix(vectors.column("vector"))), numbers(vectors, "node"), numbers(vectors, "copies")
    if quantiser:
        codes = np.frombuffer(b"".join(vectors.column("codes").to_pylist()), np.uint8).reshape(len(x), -1)
        limit = quantiser.reach + numbers(vectors, "error") + 1e-6
    out = []
    for k in range(0, len(queries), 512):
        part = queries.slice(k, 512)
        q, q_ids, q_copies = _units(_matrix(part.column("q_vector"))), numbers(part, "q_node"), numbers(part, "q_copies")
        near = quantiser.distances(q, which, codes) <= limit if quantiser else np.ones((len(q), len(x)), bool)
        rows, columns = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        if not len(rows):
            continue
        link = near[np.ix_(rows, columns)] & (q[rows] @ x[columns].T >= similarity) & (q_ids[rows][:, None] != ids[columns])
        if not link.any():
            continue
        # Vectors of this list ask each other, but not the lists that ask this one; they learn of those links here.
        missed = link & (numbers(part, "q_home")[rows] != which)[:, None]
        to_q, to_x = spanning(link, q_ids[rows], ids[columns])
        out.append((q_ids[rows], link @ copies[columns], to_q))
        out.append((ids[columns], q_copies[rows] @ missed, to_x))
    if not out:
        return _NONE
    node, links, to = (np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True))
    told = (links > 0) | (to != node)
    return pa.table({"node": node[told], "links": links[told], "to": to[told]})


def _fit(nodes: DataFrame, similarity: float) -> dict[int, Quantiser]:
    """A quantiser for each length with more vectors than its sample has at least.

    The sample is the rows of least hash of each length: its share of ``SAMPLE``, or ``LEAST_SAMPLE``. Lists are the square root
    of the vectors, as far as the sample has ``A_LIST`` for each.
    """
    counts = {r[0]: r[1] for r in nodes.groupBy("size").count().filter(F.col("count") > LEAST_SAMPLE).collect()}
    total = sum(counts.values())
    taken = {size: max(LEAST_SAMPLE, min(n, n * SAMPLE // total)) for size, n in counts.items()}
    if not taken:
        return {}
    order = Window.partitionBy("size").orderBy(F.xxhash64("node"), "node")
    wanted = F.element_at(F.create_map(*[F.lit(x) for pair in taken.items() for x in pair]), F.col("size"))
    rows = nodes.filter(F.col("size").isin(list(taken))).withColumn("rank", F.row_number().over(order))
    rows = rows.filter(F.col("rank") <= SAMPLE).filter(F.col("rank") <= wanted).select("v").toArrow()
    fitted = {}
    for size, part in _by_size(rows.combine_chunks().to_batches()[0]):
        sample = _units(_flat(part.column(0)).astype(float))
        fitted[size] = Quantiser(sample, max(1, min(int(math.sqrt(counts[size])), len(sample) // A_LIST)), similarity)
    return fitted


def measure(nodes: DataFrame, fitted: dict[int, Quantiser], similarity: float) -> dict[int, np.ndarray]:
    """For each length how many links of the measured queries are met at each rank of list; all vectors are compared with them."""
    spark = nodes.sparkSession
    asked = nodes.filter((F.col("node") % 100 == 0) & F.col("size").isin(list(fitted))).orderBy(F.xxhash64("node"), "node").limit(MEASURED)
    table = asked.select("v", "node").toArrow()
    queries = {}
    for batch in table.combine_chunks().to_batches():
        for size, part in _by_size(batch):
            queries[size] = (_units(_flat(part.column(0)).astype(float)), part.column(1).to_numpy())
    shared, held = spark.sparkContext.broadcast(fitted), spark.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for size, part in _by_size(batch):
                if size in held.value:
                    for k in range(0, part.num_rows, 4_096):
                        rows = part.slice(k, 4_096)
                        unit, ids = _units(_flat(rows.column(0)).astype(float)), rows.column(1).to_numpy()
                        ranks = shared.value[size].ranks(held.value[size][0], unit, similarity)
                        found.update((size, r) for r in ranks.tolist())
                        found[size, 0] -= int(np.isin(held.value[size][1], ids).sum())  # itself
        columns = [pa.array([k[c] for k in found], pa.int32()) for c in (0, 1)] + [pa.array(found.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["size", "rank", "links"])

    met = map_arrow(nodes.select("v", "node"), run, "size int, rank int, links long").groupBy("size", "rank").agg(F.sum("links")).collect()
    out = {size: np.zeros(len(q.centres), np.int64) for size, q in fitted.items()}
    for size, rank, links in met:
        out[size][rank] = links
    return out


def probes_for(met: np.ndarray) -> tuple[int, float]:
    """The least number of probes, ``PROBES`` at least, that meets ``RECALL`` of the measured links, and the share that it meets."""
    total = met.sum()
    if not total:
        return PROBES, 1.0
    share = np.cumsum(met) / total
    probes = max(PROBES, int(np.searchsorted(share, RECALL)) + 1)
    return probes, float(share[min(probes, len(share)) - 1])


def link_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", similarity: float = SIMILARITY, exact: bool = True
) -> DataFrame:
    """``key``, n_links, component_id (least key reachable by links) and kept for every row.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and vectors of different lengths
    don't link. Equal vectors are one node with a number of copies, so repeated rows link with each other; a row without a key
    links as node of the other rows with its vector. Other columns are not read. The sample is bounded by ``SAMPLE``, or
    ``LEAST_SAMPLE`` a length where that is more; lengths are taken to be few. Lengths with fewer vectors than that have one list.
    Every vector is indexed and asks. ``exact`` loses no link; without it as many lists are probed as ``measure`` and
    ``probes_for`` find enough for all but a thousandth of the links.
    """
    spark = vectors.sparkSession
    ship(spark)
    given = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    good = F.coalesce(finite, F.lit(False))
    least = F.coalesce(F.min("id"), F.xxhash64("v"))
    grouped = given.filter(good).groupBy("v").agg(least.alias("node"), F.count(F.lit(1)).alias("copies"))
    nodes = written(grouped.select("*", F.size("v").alias("size")), "vectors")
    fitted = _fit(nodes, similarity)
    shared = spark.sparkContext.broadcast(fitted)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = {size: np.zeros(len(q.centres)) for size, q in shared.value.items()}
        for batch in batches:
            for size, part in _by_size(batch):
                if size in most:
                    most[size] = np.maximum(most[size], shared.value[size].radii(_units(_flat(part.column(0)).astype(float))))
        for size, far in most.items():
            yield pa.RecordBatch.from_arrays([pa.array([size] * len(far), pa.int32()), pa.array(np.arange(len(far)), pa.int32()), pa.array(far)], names=["size", "list", "radius"])

    rule: dict[int, tuple] = {}
    if fitted and exact:
        farthest = map_arrow(nodes.select("v"), reach, "size int, list int, radius double").groupBy("size", "list").agg(F.max("radius"))
        ordered = sorted(tuple(r) for r in farthest.collect())
        rule = {size: (np.array([r[2] for r in ordered if r[0] == size], float), 0) for size in fitted}
    elif fitted:
        rule = {size: (None, probes_for(met)[0]) for size, met in measure(nodes, fitted, similarity).items()}
    rules = spark.sparkContext.broadcast(rule)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in _by_size(batch):
                flat = _flat(part.column(0))
                quantiser = shared.value.get(size)
                if quantiser:
                    unit = _units(flat.astype(float))
                    own, probes = quantiser.lists_and_probes(unit, *rules.value[size])
                    codes, error = quantiser.encode(unit, own)
                else:
                    own, probes = np.zeros(len(flat), int), np.ones((len(flat), 1), bool)
                    codes, error = np.zeros((len(flat), 0), np.uint8), np.zeros(len(flat))
                columns = [
                    part.column(1), part.column(2), pa.array([size] * len(flat), pa.int32()), pa.array([r.tobytes() for r in flat], pa.binary()), pa.array(own, pa.int32()),
                    pa.array([np.flatnonzero(p).tolist() for p in probes], pa.list_(pa.int32())), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "copies", "size", "vector", "list", "probes", "codes", "error"])

    schema = "node long, copies long, size int, vector binary, list int, probes array<int>, codes binary, error double"
    indexed = written(map_arrow(nodes.select("v", "node", "copies"), index, schema), "index")
    asked = indexed.select("node", "copies", "size", "vector", F.col("list").alias("home"), F.explode("probes").alias("list"))
    # One row a length and list: how many blocks of vectors and of queries it has.
    sizes = indexed.groupBy("size", "list").agg(F.ceil(F.count(F.lit(1)) / VECTORS_A_BLOCK).cast("int").alias("vector_blocks"))
    asks = asked.groupBy("size", "list").agg(F.ceil(F.count(F.lit(1)) / QUERIES_A_BLOCK).cast("int").alias("query_blocks"))
    blocks = F.broadcast(sizes.join(asks, ["size", "list"]))
    own_block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = indexed.join(blocks, ["size", "list"]).withColumn("vb", own_block("vector_blocks")).withColumn("qb", every("query_blocks"))
    right = asked.join(blocks, ["size", "list"]).withColumn("qb", own_block("query_blocks")).withColumn("vb", every("vector_blocks"))

    def compare(vectors_: pa.Table, queries_: pa.Table) -> pa.Table:
        if not len(vectors_) or not len(queries_):
            return _NONE
        size, which = (vectors_.column(c)[0].as_py() for c in ("size", "list"))
        return _compare(which, vectors_, queries_, shared.value.get(size), similarity)

    units = ["size", "list", "vb", "qb"]
    found = (
        left.select(*units, "node", "copies", "vector", "codes", "error").groupBy(*units)
        .cogroup(right.select(*units, "node", "copies", "vector", "home").toDF("q_size", "q_list", "q_vb", "q_qb", "q_node", "q_copies", "q_vector", "q_home").groupBy("q_size", "q_list", "q_vb", "q_qb"))
        .applyInArrow(compare, "node long, links long, to long")
    )
    found = written(found, "links")
    joined = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    state = nodes.join(counts, "node", "left").join(joined, "node", "left").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")
    )
    own = given.select("id", good.alias("good"), F.when(good, F.col("v")).alias("v"))
    rows = own.filter("good").join(state, "v").select("id", "n_links", "component_id")
    alone = own.filter("NOT good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return rows.unionByName(alone).select(
        F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.col("id").isNull()).alias("kept")
    )
