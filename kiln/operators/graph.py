"""Graph analytics on edge DataFrames: PageRank, single-source shortest
paths with routes, property-graph assembly.

Both iterative operators run the same round: join the per-vertex state to
the edges on the source vertex, emit one message per edge and reduce the
messages per destination (partial aggregation before the shuffle).
:class:`EdgeIndex` prepares the edges once, as tables on shared storage, so that
a round moves no edge and a lost executor only reads its buckets again:

* ordinary sources: adjacency lists, bucketed by ``src``; the state, hashed
  by vertex into as many partitions, meets them without an exchange.  A list
  holds a bounded number of edges, a vertex with more has several;
* heavy sources (more edges than a fair partition share, so fewer of them
  than partitions): edges spread evenly and joined to a broadcast of just those
  sources' state, so one vertex holding a third of all edges never lands in
  one task.

PageRank works on residuals: what a vertex received since it last passed
something on.  Only vertices with a residual worth sending touch their edges, and
several rounds run as one job that ends in a reliable ``checkpoint()``.  Shortest
paths writes the vertices that improved in a round and folds them into the
distances now and then.  Convergence figures are observed while the state is
written, so a round costs no extra job.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from kiln.session import FREE_SHUFFLES, checkpoint_dir, settings

# --- fixed values: damping terms and tolerance of the original PageRank, and
# the name given to vertices that only appear in edges ------------------------
RESET = 0.15
DAMPING = 0.85
EPSILON = 1e-7
DEFAULT_VERTEX_NAME = "missing"
# -----------------------------------------------------------------------------

INF = float("inf")
#: edges of one adjacency list, on average at most
LIST_EDGES = 4096
#: edges of one partition, on average at most: what a task holds does not grow with the graph
PARTITION_EDGES = 1 << 22
#: shares that the edges are grouped in before their number is known (put together by size),
#: and the bytes of one
GROUP_SHARES, GROUP_BYTES = 2048, "8m"
#: settings to group edges under: a task reads a short piece of a file, as what it has read
#: is grouped in its memory before the exchange
GROUPING = {**FREE_SHUFFLES, "spark.sql.files.maxPartitionBytes": "16m"}


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    return num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


@dataclass
class EdgeIndex:
    """Edges ready for repeated joins with per-vertex state on ``src``.

    ``cold``: ``(src, out_degree, own, edges array<(dst, w)>)``, adjacency lists of
    ordinary sources, bucketed by ``src``; ``hot``: ``(src, dst, w, out_degree)``,
    edges of heavy sources, spread over files; ``hot_ids``: ``(src, out_degree)`` of
    the heavy sources, fewer than ``num_partitions`` rows.  ``w`` is the weight, or the number
    of parallel edges.  ``vertices``: the ends of all edges and the ids given beside them.
    With loops, every vertex has one list that is its ``own``: it holds an edge to
    itself with ``w = 0``, along which a round hands on its state.

    The tables live in a database of their own below the checkpoint folder;
    :meth:`release` drops it with its files.
    """
    cold: DataFrame
    hot: DataFrame | None
    hot_ids: DataFrame | None
    vertices: DataFrame
    degrees: DataFrame
    num_partitions: int
    min_weight: float | None
    database: str

    @staticmethod
    def build(edges: DataFrame, num_partitions: int | None = None,
              weight: str | None = None, vertices: DataFrame | None = None,
              drop_malformed: bool = False, loops: bool = False) -> "EdgeIndex":
        """``vertices`` (column ``id``) adds vertices that need not have edges.  An edge
        without both ends (or, when weighted, without a weight) fails the job unless
        ``drop_malformed`` leaves it out.  Of parallel edges the smallest weight counts."""
        spark = edges.sparkSession
        folder = checkpoint_dir(spark)
        cols = [F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst")]
        if weight:
            cols.append(F.col(weight).cast("double").alias("weight"))
        present = F.col("src").isNotNull() & F.col("dst").isNotNull()
        if weight:
            present = present & F.col("weight").isNotNull()
        e = edges.select(*cols)
        if drop_malformed:
            e = e.where(present)
        else:
            row = F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("null"))
                                     for c in e.columns))
            ok = F.when(present, F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("malformed edge: "), row)).cast("boolean"))
            e = e.where(ok)
        name = f"kiln_edges_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/{name}'")
        # the source is read once; all else starts from this table
        value = F.min("weight") if weight else F.count(F.lit(1)).cast("double")
        with settings(spark, {**GROUPING,
                              "spark.sql.adaptive.coalescePartitions.initialPartitionNum":
                                  str(max(GROUP_SHARES, _partitions(edges, None))),
                              "spark.sql.adaptive.advisoryPartitionSizeInBytes": GROUP_BYTES}):
            e.groupBy("src", "dst").agg(value.alias("w")).write.saveAsTable(f"{name}.pairs")
        with settings(spark, GROUPING):
            return EdgeIndex._of_pairs(spark, name, num_partitions, weight, vertices, loops)

    @staticmethod
    def _of_pairs(spark: SparkSession, name: str, num_partitions: int | None, weight: str | None,
                  vertices: DataFrame | None, loops: bool) -> "EdgeIndex":
        pairs = spark.table(f"{name}.pairs")
        ends = [pairs.select(F.col(c).alias("id")) for c in ("src", "dst")]
        if vertices is not None:
            ends.append(vertices.select(F.col("id").cast("bigint").alias("id")).where("id IS NOT NULL"))
        known = reduce(DataFrame.union, ends).distinct()
        if loops:
            known.write.saveAsTable(f"{name}.vertices")
            known = spark.table(f"{name}.vertices")
        per_source = pairs.groupBy("src").agg(
            (F.count(F.lit(1)) if weight else F.sum("w").cast("bigint")).alias("out_degree"),
            F.count(F.lit(1)).alias("pairs"), F.min("w").alias("least"))
        stats = per_source.agg(F.sum("pairs").alias("m"), F.max("pairs").alias("top"),
                               F.min("least").alias("w")).first()
        n = num_partitions or max(_partitions(pairs, None), math.ceil((stats["m"] or 0) / PARTITION_EDGES))
        # heavy = more edges than a fair share of one partition: fewer than n sources
        threshold = math.ceil((stats["m"] or 0) / n)
        cold, hot, hot_ids = pairs, None, None
        if (stats["top"] or 0) > threshold:
            hot_ids = (per_source.where(F.col("pairs") > threshold)
                       .select("src", "out_degree").checkpoint(eager=True))
            cold = pairs.join(F.broadcast(hot_ids.select("src")), "src", "left_anti")
            (pairs.join(F.broadcast(hot_ids), "src").repartition(n)
             .write.saveAsTable(f"{name}.hot"))
            hot = spark.table(f"{name}.hot")
        if loops:
            cold = cold.unionByName(known.select(F.col("id").alias("src"), F.col("id").alias("dst"),
                                                 F.lit(0.0).alias("w")))
        # everything below is clustered by src already: no exchange but this one
        cold = cold.repartition(n, "src")
        own_rows = Window.partitionBy("src")
        degree = F.count(F.lit(1)).over(own_rows) if weight else F.sum("w").over(own_rows).cast("bigint")
        lists = (cold.withColumn("out_degree", degree)
                 .withColumn("lists", F.ceil(F.count(F.lit(1)).over(own_rows) / LIST_EDGES))
                 .withColumn("list", F.pmod(F.xxhash64("dst"), "lists"))
                 .groupBy("src", "out_degree", "list")
                 .agg((F.min("w") == 0).alias("own") if loops else F.lit(False).alias("own"),
                      F.collect_list(F.struct("dst", "w")).alias("edges")).drop("list"))
        (lists.write.bucketBy(n, "src").sortBy("src").saveAsTable(f"{name}.cold"))
        return EdgeIndex(spark.table(f"{name}.cold"), hot, hot_ids, known,
                         per_source.select("src", "out_degree"), n, stats["w"], name)

    def release(self) -> None:
        """Drop the tables with their files (results are checkpointed, nothing built on
        them remains)."""
        self.vertices.sparkSession.sql(f"DROP DATABASE {self.database} CASCADE")

    def join_lists(self, state: DataFrame, key: str = "id") -> DataFrame:
        """The adjacency lists of ordinary sources that have a row in ``state``, with the
        state's columns: the state is sorted into the buckets, the lists stay."""
        return self.cold.hint("merge").join(state, self.cold.src == state[key])

    def join_hot(self, state: DataFrame, key: str = "id") -> DataFrame | None:
        """The edges of heavy sources that have a row in ``state``, with its columns."""
        if self.hot is None:
            return None
        heavy = self.hot_ids.select(F.col("src").alias("_hot_src"))
        hot_state = state.join(F.broadcast(heavy), state[key] == heavy._hot_src).drop("_hot_src")
        return self.hot.join(F.broadcast(hot_state), self.hot.src == hot_state[key])

    def join_state(self, state: DataFrame, key: str = "id") -> DataFrame:
        """Every edge ``(src, out_degree, dst, w)`` whose source has a row in ``state`` (one
        row per vertex, keyed by ``key``), with the state's columns added."""
        cols = ["src", "out_degree", "dst", "w", *state.columns]
        cold = self.join_lists(state, key).select(
            "src", "out_degree", *state.columns, F.inline("edges")).select(cols)
        hot = self.join_hot(state, key)
        return cold if hot is None else cold.unionByName(hot.select(cols))


def _cut(df: DataFrame, metric: Column | None = None) -> tuple[DataFrame, object]:
    """Write ``df`` as a reliable checkpoint and continue from the files.

    ``metric`` (an aggregate) is observed while the checkpoint is written, so
    a round's convergence test costs no extra job; returns ``(df, value)``.
    """
    if metric is None:
        return df.checkpoint(eager=True), None
    obs = Observation()
    out = df.observe(obs, metric.alias("m")).checkpoint(eager=True)
    return out, obs.get["m"]


class NotConverged(RuntimeError):
    """A given number of rounds was reached before the result was final."""


@dataclass
class PageRankResult:
    ranks: DataFrame        # (id, rank)
    rounds: int             # rank updates performed
    converged: bool


def pagerank(edges: DataFrame, vertices: DataFrame | None = None, max_iter: int | None = None,
             tol: float | None = EPSILON, signed_tolerance: bool = False,
             drop_unlinked: bool = False, num_partitions: int | None = None,
             drop_malformed: bool = False) -> PageRankResult:
    """Unnormalised PageRank: start at 1.0, ``rank = 0.15 + 0.85 * sum(rank(u)
    / out_degree(u))`` over in-links ``u``.

    Stops when every rank moved by at most ``tol``.  With ``max_iter`` it fails
    (:class:`NotConverged`) when that takes more updates; ``tol=None`` asks for
    exactly ``max_iter`` updates instead.  Parallel edges count with their
    multiplicity.  ``vertices`` (column ``id``) adds vertices without edges;
    malformed edges fail unless ``drop_malformed``.

    Defaults fix two quirks of the original recursion; flags restore them:
    ``signed_tolerance`` compares ``new - old <= tol`` without absolute value
    (a falling rank counts as converged); ``drop_unlinked`` starts with the
    source vertices only and keeps after each update only vertices that
    received a contribution (by default every vertex is kept, ``0.15``
    without in-links; sinks keep their rank and pass none on).
    """
    if tol is None and max_iter is None:
        raise ValueError("give a tolerance or a number of updates")
    idx = EdgeIndex.build(edges, num_partitions, None, vertices, drop_malformed, loops=not drop_unlinked)
    run = _linked_ranks if drop_unlinked else _residual_ranks
    try:
        ranks, rounds, converged = run(idx, max_iter, tol, signed_tolerance)
    finally:
        idx.release()
    if tol is not None and not converged:
        raise NotConverged(f"ranks still move after {rounds} updates")
    return PageRankResult(ranks.select("id", "rank"), rounds, converged)


#: updates that run as one job, between two checkpoints; an even number
ROUNDS_PER_JOB = 4
#: share of the tolerance by which the moves may still differ from geometric series
SETTLED = 1e-7
#: share of the tolerance below which a residual waits at its vertex
HOLD = 1e-5


def _residual_round(idx: EdgeIndex, state: DataFrame, hold: float, first: bool) -> DataFrame:
    """``(id, rank, res)`` after one update.

    A vertex passes its residual on along its edges and its rank to itself along its own
    list; one whose residual is not above ``hold`` keeps it and touches no edge.  A kept
    residual travels as a contribution, which the rank handed on leaves out."""
    # the first update starts from ranks of 1: 0.15 + 0.85 * sum, less the 1
    offset = RESET - 1.0 if first else 0.0
    hot = "" if idx.hot is None else f"""
        UNION ALL
        SELECT dst, res * w / e.out_degree, CAST(NULL AS DOUBLE)
        FROM {{hot}} e JOIN (SELECT /*+ BROADCAST(h) */ id, res FROM {{state}} s JOIN {{ids}} h ON s.id = h.src
                             WHERE abs(res) > {hold!r}) b ON e.src = b.id"""
    extra = {} if idx.hot is None else {"hot": idx.hot, "ids": idx.hot_ids}
    return state.sparkSession.sql(f"""
        SELECT id, rank + res + {offset!r} AS rank, res + {offset!r} AS res FROM (
          SELECT dst AS id, max(rank) AS rank, {DAMPING!r} * coalesce(sum(c), 0.0D) AS res FROM (
            SELECT dst, CASE WHEN w <> 0 THEN give * w ELSE wait / {DAMPING!r} END AS c,
                   CASE WHEN w = 0 THEN rank - coalesce(wait, 0.0D) END AS rank
            FROM (SELECT inline(CASE WHEN abs(res) > {hold!r} THEN edges
                                     ELSE array(named_struct('dst', id, 'w', 0.0D)) END),
                         res / out_degree AS give, rank, CASE WHEN abs(res) <= {hold!r} THEN res END AS wait
                  FROM (SELECT /*+ SHUFFLE_HASH(s) */ * FROM {{cold}} e JOIN {{state}} s ON e.src = s.id
                        WHERE abs(res) > {hold!r} OR own))
            {hot}) GROUP BY dst)""", cold=idx.cold, state=state, **extra)


def _fixed_plans(spark: SparkSession, partitions: int):
    """Without adaptive execution: a round's plan is the same every time, its exchange has as
    many partitions as the index has buckets, and planning anew after each of a job's
    many stages takes as long as a small round."""
    return settings(spark, {**FREE_SHUFFLES, "spark.sql.adaptive.enabled": "false",
                            "spark.sql.shuffle.partitions": str(partitions)})


def _series_gap(before: DataFrame, after: DataFrame, n: int) -> float:
    """How far the moves ``n`` updates later are from ``0.85 ** n`` times what they were: the
    largest difference by rank, times the largest rank.

    An update takes a vector that is nowhere above a multiple of the ranks to one that is
    nowhere above the same multiple of them, so the difference does not grow later on."""
    both = after.join(before.select("id", F.col("res").alias("was")), "id")
    off = F.abs(F.col("res") - DAMPING ** n * F.col("was"))
    gap, top = both.agg(F.max(off / F.col("rank")), F.max("rank")).first()
    return (gap or 0.0) * (top or 0.0)


def _end_of_series(odd: tuple[DataFrame, float], even: tuple[DataFrame, float],
                   tol: float) -> tuple[DataFrame, int]:
    """The state at the first update that moves no rank by more than ``tol``, and how many
    updates after ``even`` it is, when the moves of every second update are 0.85 squared
    times those before.  ``odd`` and ``even`` are the last two states with their largest moves."""
    later, sums = 0, [0.0, 0.0]
    while True:
        later += 1
        k = later % 2
        factor = DAMPING ** (later + k)
        sums[k] += factor
        if factor * (odd if k else even)[1] <= tol:
            break
    ranks = even[0].join(odd[0].select("id", F.col("res").alias("was")), "id").select(
        "id", (F.col("rank") + sums[1] * F.col("was") + sums[0] * F.col("res")).alias("rank"))
    return _cut(ranks)[0], later


def _residual_ranks(idx: EdgeIndex, max_iter: int | None, tol: float | None,
                    signed: bool) -> tuple[DataFrame, int, bool]:
    """Ranks of all vertices.  The updates are those of the plain recursion: what moves a
    rank in one update is 0.85 times what moved its in-neighbours in the one before.

    In most graphs the moves soon fall by 0.85 an update, in a two-sided one by its square
    every second update, while they are still far above ``tol``.  Once they do for every
    vertex, what is left of the recursion is two geometric series, which are summed up to the
    update at which the recursion stops."""
    with _fixed_plans(idx.vertices.sparkSession, idx.num_partitions):
        return _residual_updates(idx, max_iter, tol, signed)


def _residual_updates(idx: EdgeIndex, max_iter: int | None, tol: float | None,
                      signed: bool) -> tuple[DataFrame, int, bool]:
    hold = 0.0 if tol is None else tol * HOLD
    state, _ = _cut(idx.vertices.select("id", F.lit(1.0).alias("rank"), F.lit(1.0).alias("res")))
    rounds = 0
    worst = F.max(F.col("res") if signed else F.abs("res"))

    def job(n: int) -> tuple[DataFrame, float | None]:
        cur = state
        for k in range(n):
            cur = _residual_round(idx, cur, hold, rounds + k == 0)
        return _cut(cur, worst)

    # without absolute value the largest move can fall below the tolerance and rise again
    single = signed
    series = tol is not None and not signed
    tail: list[tuple[DataFrame, float | None]] | None = None    # single updates once they look settled
    while max_iter is None or rounds < max_iter:
        n = 1 if single or tail is not None else ROUNDS_PER_JOB
        n = n if max_iter is None else min(n, max_iter - rounds)
        new, moved = job(n)
        still = tol is not None and (moved is None or moved <= tol)
        if still and n > 1:
            # the first update that moves no rank is among these: take them one by one
            single = True
            continue
        before, state, rounds = state, new, rounds + n
        if still:
            return state, rounds, True
        if not series or single:
            continue
        if tail is None:
            if n == ROUNDS_PER_JOB and _series_gap(before, state, n) <= tol * SETTLED:
                tail = [(state, moved)]
            continue
        tail.append((state, moved))
        if len(tail) == 3:
            if _series_gap(tail[0][0], state, 2) <= tol * SETTLED:
                done, later = _end_of_series(tail[1], tail[2], tol)
                if max_iter is not None and rounds + later > max_iter:
                    return state, max_iter, False
                return done, rounds + later, True
            tail = None
    return state, rounds, False


def _linked_ranks(idx: EdgeIndex, max_iter: int | None, tol: float | None,
                  signed: bool) -> tuple[DataFrame, int, bool]:
    """Ranks that start at the sources and stay with vertices that receive something."""
    state, _ = _cut(idx.degrees.select(F.col("src").alias("id"), F.lit(1.0).alias("rank")))
    rounds = 0
    while max_iter is None or rounds < max_iter:
        sums = (idx.join_state(state)
                .select("dst", (F.col("rank") * F.col("w") / F.col("out_degree")).alias("c"))
                .groupBy("dst").agg(F.sum("c").alias("s")))
        new = (sums.join(state, sums.dst == state.id, "left")
               .select(F.col("dst").alias("id"), (RESET + DAMPING * F.col("s")).alias("rank"),
                       F.col("rank").alias("prev")))
        moved = F.col("rank") - F.col("prev")
        # largest move among vertices present in both rounds (null: none)
        state, worst = _cut(new, F.max(moved if signed else F.abs(moved)) if tol is not None else None)
        state, rounds = state.select("id", "rank"), rounds + 1
        if tol is not None and (worst is None or worst <= tol):
            return state, rounds, True
    return state, rounds, False


def property_graph(vertices: DataFrame, edges: DataFrame, default: str = DEFAULT_VERTEX_NAME,
                   attr: str = "name") -> DataFrame:
    """All vertices of a graph as ``(id, attr)``: one row per id -- the given
    vertices (an id listed twice keeps its smallest attribute) plus every
    edge endpoint without a vertex row, which gets ``default``."""
    named = vertices.groupBy("id").agg(F.min(attr).alias(attr))
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    missing = ends.join(named.select("id"), "id", "left_anti").select(
        "id", F.lit(default).alias(attr))
    return named.unionByName(missing)


@dataclass
class ShortestPaths:
    distances: DataFrame    # (id, dist, hops, pred): every vertex; unreached = (inf, null, null)
    rounds: int


class NegativeCycle(ValueError):
    """A cycle of negative weight is reachable, so there are no shortest routes; ``cycle`` holds
    ``(id, pred)`` of the vertices on such cycles."""

    def __init__(self, cycle: DataFrame):
        n, least = cycle.agg(F.count(F.lit(1)), F.min("id")).first()
        super().__init__(f"negative cycle: {n} vertices, the smallest is {least}")
        self.cycle = cycle


#: rounds of improvements that are kept beside the distances before they are folded in
FOLD_ROUNDS = 8


def shortest_distances(edges: DataFrame, source: int, weight: str = "weight",
                       num_partitions: int | None = None, max_iter: int | None = None,
                       index: EdgeIndex | None = None, vertices: DataFrame | None = None,
                       drop_malformed: bool = False) -> ShortestPaths:
    """Distances from ``source`` over directed weighted edges, by frontier
    relaxation: only vertices improved in the last round send messages.

    Each vertex ends with the lexicographically smallest ``(dist, hops, pred)``:
    shortest distance, then fewest edges among shortest routes (this makes
    route selection well defined with zero-weight edges), then the smallest
    source among its in-edges on such a route.  An offer that only lowers
    ``pred`` does not make the vertex send again.  Every in-edge of a final
    value is offered once (the round after its source last changed), so
    ``pred`` needs no extra pass over the edges.

    A round writes the vertices it improved; they are folded into the distances
    every ``FOLD_ROUNDS`` rounds.  Rounds run until no vertex improves (at most
    the hop count of the longest shortest route plus one); with ``max_iter`` it
    fails (:class:`NotConverged`) when that takes more.  ``vertices`` (column
    ``id``) adds vertices without edges; a source that is no vertex reaches
    none.  Weights may be negative; a cycle of negative weight that the source reaches
    raises :class:`NegativeCycle`.  It is looked for after 8, 16, 32, .. rounds, in the
    predecessors: on a cycle of predecessors every value is at least its predecessor's
    plus the edge, with more hops, so the weights add up to less than zero; and once values
    are below every route without repeats, the predecessors must have a cycle.
    Malformed edges fail unless ``drop_malformed``.
    """
    if index is None:
        idx = EdgeIndex.build(edges, num_partitions, weight, vertices, drop_malformed)
        try:
            return shortest_distances(edges, source, weight, num_partitions, max_iter, idx)
        finally:
            idx.release()
    with settings(index.vertices.sparkSession, {**FREE_SHUFFLES, "spark.sql.shuffle.partitions": str(index.num_partitions)}):
        return _relax(index, source, max_iter)


def _relax(idx: EdgeIndex, source: int, max_iter: int | None) -> ShortestPaths:
    """The rounds of :func:`shortest_distances`."""
    signed = idx.min_weight is not None and idx.min_weight < 0
    look_at = FOLD_ROUNDS
    value = F.struct("dist", "hops", "pred")
    base, _ = _cut(idx.vertices.where(F.col("id") == F.lit(source)).select(
        "id", F.lit(0.0).alias("dist"), F.lit(0).alias("hops"),
        F.lit(None).cast("bigint").alias("pred")))
    frontier, recent, rounds = base, [], 0

    def folded() -> DataFrame:
        rows = reduce(DataFrame.unionByName, recent, base)
        return rows.groupBy("id").agg(F.min(value).alias("v")).select("id", "v.*")

    while True:
        if max_iter is not None and rounds >= max_iter:
            raise NotConverged(f"distances still fall after {rounds} rounds")
        offers = idx.join_state(frontier).select(
            "dst", F.struct((F.col("dist") + F.col("w")).alias("dist"),
                            (F.col("hops") + 1).alias("hops"), F.col("src").alias("pred")).alias("m"))
        best = offers.groupBy("dst").agg(F.min("m").alias("b"))
        # a vertex has a row for each time it improved, the smallest counts
        known = reduce(DataFrame.unionByName, recent, base).select(F.col("id").alias("k"), value.alias("v"))
        met = (best.join(known, F.col("dst") == F.col("k"), "left")
               .groupBy("dst").agg(F.min("b").alias("b"), F.min("v").alias("v")))
        moved = F.col("v").isNull() | (F.struct("b.dist", "b.hops") < F.struct("v.dist", "v.hops"))
        better = met.where(moved | (F.col("b") < F.col("v"))).select(
            F.col("dst").alias("id"), "b.*", moved.alias("moved"))
        changed, n = _cut(better, F.struct(F.count_if("moved").alias("n"), F.count(F.lit(1)).alias("all")))
        rounds += 1
        if n["all"]:
            recent.append(changed.drop("moved"))
        if n["n"] == 0:
            break
        frontier = changed.where("moved").drop("moved")
        if len(recent) >= FOLD_ROUNDS:
            base, recent = _cut(folded())[0], []
        if signed and rounds >= look_at:
            look_at *= 2
            cycle = predecessor_cycles(folded().select("id", "pred"), idx.num_partitions)
            if cycle is not None:
                raise NegativeCycle(cycle)
    reached = folded()
    state, _ = _cut(idx.vertices.join(reached, "id", "left").select(
        "id", F.coalesce("dist", F.lit(INF)).alias("dist"), "hops", "pred"))
    return ShortestPaths(state, rounds)


def predecessors(idx: EdgeIndex, dist: DataFrame, source: int) -> DataFrame:
    """``(id, pred)`` recomputed from final ``(id, dist, hops)`` alone: the
    smallest ``src`` among in-edges with ``dist(src) + w = dist(id)`` and
    ``hops(src) + 1 = hops(id)``.  One partial-aggregating pass over all
    edges: the minimum of ``(dist+w, hops+1, src)`` per destination is the
    destination's own ``(dist, hops)`` with the smallest such ``src``.
    (:func:`shortest_distances` already returns ``pred``; this is for
    distances obtained elsewhere.)"""
    reached = dist.where(F.col("dist") < INF).select("id", "dist", "hops")
    msgs = idx.join_state(reached).select(
        "dst", F.struct((F.col("dist") + F.col("w")).alias("d"),
                        (F.col("hops") + 1).alias("h"), F.col("src").alias("s")).alias("m"))
    best = msgs.groupBy("dst").agg(F.min("m").alias("b"))
    return (best.where(F.col("dst") != F.lit(source))
            .select(F.col("dst").alias("id"), F.col("b.s").alias("pred")))


#: pieces that a fair partition share of one ancestor's followers is cut into
PIECES = 16


def _follow(rows: DataFrame, look: DataFrame, n: int, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``look`` (one row per ``a_id``) on ``anc = a_id``.

    An ancestor that more rows share than fit a fair partition share is split: its
    row is repeated, and its followers are dealt over the copies by their id.  Such
    ancestors are fewer than partitions, so their list is broadcast; the rest is hashed."""
    counts = rows.groupBy("anc").agg(F.count(F.lit(1)).alias("n"))
    fair = rows.agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(n)), F.lit(1))).first()[0]
    heavy = (counts.where(F.col("n") > fair)
             .select(F.col("anc").alias("h_id"), F.ceil(F.col("n") * PIECES / fair).alias("h_n"))
             .checkpoint(eager=True))
    dealt = (rows.join(F.broadcast(heavy), F.col("anc") == F.col("h_id"), "left")
             .withColumn("piece", F.pmod(F.xxhash64("id"), F.coalesce("h_n", F.lit(1))))
             .drop("h_id", "h_n"))
    copies = (look.join(F.broadcast(heavy), F.col("a_id") == F.col("h_id"), "left")
              .withColumn("a_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("h_n", F.lit(1)) - 1)))
              .drop("h_id", "h_n"))
    same = (F.col("anc") == F.col("a_id")) & (F.col("piece") == F.col("a_piece"))
    return dealt.join(copies, same, how).drop("piece", "a_piece")


def predecessor_cycles(preds: DataFrame, num_partitions: int | None = None) -> DataFrame | None:
    """``(id, pred)`` of the vertices on cycles of ``(id, pred)``, None without any.

    Pointer jumping: vertices whose chain ends drop out; what is left after more jumps
    than the vertices' number has binary digits is on a cycle or leads to one, and the
    ancestors reached are exactly the vertices of the cycles."""
    n = _partitions(preds, num_partitions)
    preds, left = _cut(preds.where("pred IS NOT NULL"), F.count(F.lit(1)))
    state, jumps = preds.select("id", F.col("pred").alias("anc")), left.bit_length() + 1
    for _ in range(jumps):
        if not left:
            return None
        look = state.select(F.col("id").alias("a_id"), F.col("anc").alias("a_anc"))
        state, left = _cut(_follow(state, look, n).select("id", F.col("a_anc").alias("anc")), F.count(F.lit(1)))
    if not left:
        return None
    return preds.join(state.select(F.col("anc").alias("id")).distinct(), "id", "left_semi").checkpoint()


def routes(preds: DataFrame, source: int, num_partitions: int | None = None) -> DataFrame:
    """``(id, path)``: the vertices from ``source`` to the predecessor of
    ``id`` (destination excluded), by pointer jumping: each round a vertex
    jumps to its ancestor's ancestor and prepends the ancestor's segment, so
    a route of L edges is complete after about log2(L) rounds.  An ancestor that
    many vertices share is split (:func:`_follow`)."""
    n = _partitions(preds, num_partitions)
    st, remaining = _cut(preds.select("id", F.col("pred").alias("anc"),
                                      F.array("pred").alias("seg"),
                                      (F.col("pred") == F.lit(source)).alias("done")),
                         F.count_if(~F.col("done")))
    while remaining > 0:
        look = st.select(F.col("id").alias("a_id"), F.col("anc").alias("a_anc"),
                         F.col("seg").alias("a_seg"), F.col("done").alias("a_done"))
        todo = _follow(st.where(~F.col("done")), look, n)
        jumped = todo.select("id", F.col("a_anc").alias("anc"),
                             F.concat("a_seg", "seg").alias("seg"), F.col("a_done").alias("done"))
        st, remaining = _cut(st.where("done").unionByName(jumped), F.count_if(~F.col("done")))
    return st.select("id", F.col("seg").alias("path"))


def shortest_paths(edges: DataFrame, source: int, weight: str = "weight",
                   num_partitions: int | None = None, max_iter: int | None = None,
                   vertices: DataFrame | None = None, drop_malformed: bool = False) -> DataFrame:
    """``(id, dist, path)`` for every vertex: distance from ``source`` and the
    route to it (vertices from the source up to the predecessor; the source
    itself and unreached vertices get ``[]``, unreached ``dist`` is inf).

    Among equally short routes the one with fewest edges is taken, then the
    smallest predecessor at each step.
    """
    sp = shortest_distances(edges, source, weight, num_partitions, max_iter,
                            vertices=vertices, drop_malformed=drop_malformed)
    preds = sp.distances.where(F.col("pred").isNotNull()).select("id", "pred")
    with settings(edges.sparkSession, FREE_SHUFFLES):
        paths = routes(preds, source)
    return (sp.distances.join(paths, "id", "left")
            .select("id", "dist", F.coalesce("path", F.array().cast("array<bigint>")).alias("path")))
