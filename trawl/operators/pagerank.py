"""PageRank over (src, dst, weight) edges (P6, P7, P9; J1-J9, A1-A3, F14-F15, U3, O1-O2, K6).

Ranks are not normalised: 0.15 + 0.85 * sum(rank * weight).  A source without a
rank counts 0.15.  Each step reads the ranks of the step before.  The edges are
bucketed by src once, so a step moves the ranks and the partial sums only; a source
of more than HUB_EDGES edges lies in several parts, each of which gets its rank.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trawl.scratch import bucketed, delete, new_path, written

BASE, DAMPING = 0.15, 0.85
HUB_EDGES = 10_000_000


@dataclass
class Result:
    ranks: DataFrame
    iterations: int
    max_diff: float | None
    #: The edges as they were laid out.
    edges: DataFrame | None = None


def with_inlinks(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices that an edge points to."""
    return vertices.join(edges.select(F.col("dst").alias("id")), "id", "left_semi")


def orphans(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices that no edge points to."""
    return vertices.join(edges.select(F.col("dst").alias("id")), "id", "left_anti")


def contributions(edges: DataFrame, ranks: DataFrame, hubs: DataFrame | None = None) -> DataFrame:
    """id and new rank of every target (A1, J2); `hubs` has the parts of the sources that have several."""
    share = F.coalesce(F.col("rank"), F.lit(BASE)) * F.col("weight")
    own, keys = ranks.select(F.col("id").alias("src"), "rank"), ["src"]
    if hubs is not None:
        parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
        own, keys = own.join(hubs, "src", "left").select("src", "rank", F.explode(parts).alias("part")), ["src", "part"]
    return (
        edges.join(own, keys, "left")
        .groupBy(F.col("dst").alias("id"))
        .agg((F.lit(BASE) + F.lit(DAMPING) * F.sum(share)).alias("new_rank"))
    )


def laid_out(edges: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The edges bucketed by src, and the sources that lie in several parts (None when there are none)."""
    spark = edges.sparkSession
    own = edges.select("src", "dst", F.col("weight").cast("double").alias("weight"))
    buckets, hubs = int(spark.conf.get("spark.sql.shuffle.partitions")), _hubs(own)
    if hubs.isEmpty():
        return bucketed(own, ["src"], buckets), None
    part = F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1))).cast("int")
    return bucketed(own.join(hubs, "src", "left").withColumn("part", part).drop("parts"), ["src", "part"], buckets), hubs


def _hubs(edges: DataFrame) -> DataFrame:
    found = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HUB_EDGES)
    return written(found.select("src", F.ceil(F.col("n") / HUB_EDGES).cast("int").alias("parts")), "hubs")


def laid_out_unweighted(edges: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """A bare edge list without its repeats, weighted by 1 / out-degree and laid out; its rows are moved once, to the buckets.

    With hubs, whose rows must not meet in one task, repeats and degrees are found by exchanges of their own.
    """
    own = edges.select("src", "dst").where("src is not null")
    if not _hubs(own).isEmpty():
        return laid_out(written(unweighted(own), "edges"))
    buckets = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    degree = F.count(F.lit(1)).over(Window.partitionBy("src"))
    weights = own.repartition(buckets, "src").dropDuplicates(["src", "dst"]).withColumn("weight", F.lit(1.0) / degree)
    return bucketed(weights, ["src"], buckets, placed=True), None


def ends(edges: DataFrame) -> DataFrame:
    """The vertices of an edge list."""
    return edges.select(F.col("src").alias("id")).distinct().unionByName(edges.select(F.col("dst").alias("id")).distinct()).distinct()


def step(edges: DataFrame, ranks: DataFrame, precision: float = 0.0, hubs: DataFrame | None = None) -> DataFrame:
    """id, rank, new_rank of the ranks; a change of at most `precision` is none."""
    changed = F.abs(F.col("rank") - F.col("new_rank")) > precision
    return ranks.join(contributions(edges, ranks, hubs), "id", "left").withColumn("new_rank", F.when(changed, F.col("new_rank")).otherwise(F.col("rank")))


def diff_stats(diffs: DataFrame, old: str = "rank", new: str = "new_rank") -> DataFrame:
    """Sum, count, extremes, mean and sample deviation of the changes."""
    d = F.abs(F.col(new) - F.col(old))
    return diffs.where(F.col(new) != F.col(old)).agg(
        F.sum(d).alias("sum_diff"), F.count(F.lit(1)).alias("count_diff"), F.min(d).alias("min_diff"), F.max(d).alias("max_diff"), F.avg(d).alias("avg_diff"), F.stddev(d).alias("stddev_diff")
    )


def top_diffs(diffs: DataFrame, names: DataFrame, n: int = 100) -> DataFrame:
    """The n largest changes with their domains."""
    d = F.abs(F.col("new_rank") - F.col("rank"))
    top = diffs.where("rank <> new_rank").withColumn("diff", d).orderBy(F.col("diff").desc(), "id").limit(n)
    return top.join(names, "id").select("id", "domain", "rank", "new_rank", "diff").orderBy(F.col("diff").desc(), "id")


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    max_iterations: int = 5,
    precision: float = 1e-6,
    tolerance: float = -1.0,
    stats_every: int = 5,
    include_orphans: bool = False,
    all_vertices: bool = False,
    on_stats: Callable[[int, DataFrame], None] | None = None,
) -> Result:
    """Iterate until nothing changes by more than `precision` or, every `stats_every` steps, than `tolerance`.

    `all_vertices` starts every vertex at 1 and ranks each in every step (P7).  A step
    reads the ranks before it twice, so each is written to the shared folder, where a
    lost executor can't take it along, and the table before is deleted.  `on_stats` is
    called with the step's number and its id, rank, new_rank whenever differences are looked at.
    """
    return _iterated(vertices, *laid_out(edges), max_iterations, precision, tolerance, stats_every, include_orphans, all_vertices, on_stats)


def _iterated(vertices, laid, hubs, max_iterations=5, precision=1e-6, tolerance=-1.0, stats_every=5, include_orphans=False, all_vertices=False, on_stats=None) -> Result:
    spark = vertices.sparkSession
    start = vertices if all_vertices else with_inlinks(vertices, laid)
    ranks = written(start.select("id", F.lit(1.0).alias("rank")), "ranks")
    last_path, max_diff, done = None, None, 0
    for n in range(1, max_iterations + 1):
        new = full_step(laid, ranks, hubs) if all_vertices else step(laid, ranks, precision, hubs)
        path = new_path(spark, "ranks")
        new.write.parquet(path)
        new = spark.read.schema(new.schema).parquet(path)
        if stats_every > 0 and n % stats_every == 0:
            if on_stats is not None:
                on_stats(n, new)
            max_diff = diff_stats(new).first()["max_diff"]
            if max_diff is None or max_diff <= tolerance:
                delete(spark, path)
                break
        ranks, done = new.select("id", F.col("new_rank").alias("rank")), n
        if last_path:
            delete(spark, last_path)
        last_path = path
    if include_orphans and not all_vertices:
        ranks = ranks.unionByName(orphans(vertices, laid).select("id", F.lit(BASE).alias("rank")))
    return Result(ranks, done, max_diff, laid)


def full_step(edges: DataFrame, ranks: DataFrame, hubs: DataFrame | None = None) -> DataFrame:
    """Every vertex ranked anew; one without in-links falls to the base."""
    return ranks.join(contributions(edges, ranks, hubs), "id", "left").withColumn("new_rank", F.coalesce("new_rank", F.lit(BASE)))


def unweighted(edges: DataFrame) -> DataFrame:
    """Weights of an edge list that has none: 1 / out-degree."""
    from trawl.operators.links import weighted

    return weighted(edges.select("src", "dst").distinct(), "double")


def pagerank_unweighted(edges: DataFrame, max_iterations: int = 5, all_vertices: bool = True, **options) -> Result:
    """PageRank of a bare edge list: its vertices, each ranked in every step (P8, P9), or those with in-links."""
    laid, hubs = laid_out_unweighted(edges)
    return _iterated(ends(laid), laid, hubs, max_iterations, all_vertices=all_vertices, **options)


def named(ranks: DataFrame, names: DataFrame, value: Column | None = None) -> DataFrame:
    """domain and rank, greatest first."""
    return ranks.join(names, "id").select("domain", "rank").orderBy(F.col("rank").desc(), "domain")


def rank_lines(ranks: DataFrame, names: DataFrame) -> DataFrame:
    """"domain rank" lines (K2)."""
    return named(ranks, names).select(F.concat_ws(" ", "domain", F.col("rank").cast("float").cast("string")).alias("r"))
