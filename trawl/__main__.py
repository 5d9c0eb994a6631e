"""python -m trawl pipeline|pagerank|webgraph|import|search ...."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from trawl.operators import links
from trawl.operators.pagerank import diff_stats, named, pagerank, pagerank_unweighted, rank_lines, top_diffs
from trawl.plans import pipeline
from trawl.plans.sinks import save
from trawl.sources.datasets import PROVIDERS, imported


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="trawl")
    out.add_argument("--shuffle_partitions", type=int)
    jobs = out.add_subparsers(dest="job", required=True)
    p = jobs.add_parser("pipeline", help="read, parse, rank and index pages, run plugins")
    p.add_argument("--source", action="append", required=True)
    p.add_argument("--plugin", action="append", default=[])
    p.add_argument("--records", help="the table that `import` wrote")
    p.add_argument("--index", help="folder of the search index to write")
    p = jobs.add_parser("pagerank", help="rank the vertices of a graph")
    p.add_argument("--webgraph", required=True)
    p.add_argument("--output")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--maxiter", type=int, default=5)
    p.add_argument("--precision", type=float, default=1e-6)
    p.add_argument("--tol", type=float, default=0.001)
    p.add_argument("--stats", type=int, default=5)
    p.add_argument("--maxedges", type=int)
    p.add_argument("--maxvertices", type=int)
    p.add_argument("--include_orphans", action="store_true")
    p.add_argument("--implementation", choices=("delta", "full", "unweighted"), default="delta")
    p.add_argument("--top_diffs", type=int, default=0, help="print that many of the largest changes with the statistics")
    p.add_argument("--gzip", action="store_true")
    p.add_argument("--coalesce", type=int, default=1)
    p = jobs.add_parser("webgraph", help="export a graph as text")
    p.add_argument("--input_parquet", required=True)
    p.add_argument("--output_txt", required=True)
    p.add_argument("--gzip", action="store_true")
    p.add_argument("--coalesce", type=int, default=1)
    p = jobs.add_parser("import", help="merge static URL datasets")
    p.add_argument("--output", required=True)
    for name in PROVIDERS:
        p.add_argument(f"--{name}")
    p = jobs.add_parser("search", help="query an index")
    p.add_argument("--index", required=True)
    p.add_argument("--lang")
    p.add_argument("query")
    return out


def shown(df: DataFrame) -> None:
    """Every row, fetched a partition at a time (K3)."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator(prefetchPartitions=True):
        print("\t".join(map(str, row)))


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"trawl {args.job}").getOrCreate()
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    if args.job == "pipeline":
        records = spark.read.parquet(args.records) if args.records else None
        df = pipeline.run(spark, args.source, args.plugin, records, args.index)
        if not args.plugin and not args.index:
            print(df.count())
    elif args.job == "pagerank":
        vertices, edges = (spark.read.parquet(f"{args.webgraph}/{x}") for x in ("vertices", "edges"))
        vertices = vertices if args.maxvertices is None else vertices.limit(args.maxvertices)
        edges = edges if args.maxedges is None else edges.limit(args.maxedges)

        def told(n: int, diffs: DataFrame) -> None:
            print(n, *[f"{k}={v}" for k, v in diff_stats(diffs).first().asDict().items()])
            if args.top_diffs:
                shown(top_diffs(diffs, vertices, args.top_diffs))

        if args.implementation == "unweighted":
            found = pagerank_unweighted(edges, args.maxiter, precision=args.precision, tolerance=args.tol, stats_every=args.stats, on_stats=told)
        else:
            found = pagerank(vertices, edges, args.maxiter, args.precision, args.tol, args.stats, include_orphans=args.include_orphans, all_vertices=args.implementation == "full", on_stats=told)
        if args.output:
            save(rank_lines(found.ranks, vertices), args.output, "text", args.coalesce, args.gzip, mode="overwrite" if args.overwrite else "errorifexists")
        else:
            shown(named(found.ranks, vertices))
    elif args.job == "webgraph":
        for name, lines in (("vertices", links.vertex_lines), ("edges", links.edge_lines)):
            save(lines(spark.read.parquet(f"{args.input_parquet}/{name}")), f"{args.output_txt}/{name}", "text", args.coalesce, args.gzip)
    elif args.job == "import":
        imported(spark, {k: getattr(args, k) for k in PROVIDERS if getattr(args, k)}).write.mode("overwrite").parquet(args.output)
    else:
        shown(pipeline.search_debug(spark, args.index, args.query, args.lang))


if __name__ == "__main__":
    main()
