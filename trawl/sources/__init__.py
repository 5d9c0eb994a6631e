"""Sources of pages: each is a function of its options that gives a DataFrame.

The rows have url, headers, doc_type, index_level and body (binary), or, from a
source that is parsed already, the columns of the metadata table.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PAGE = "url string, headers map<string,string>, doc_type string, body binary, source_path string, pos long"
NAMES = {
    "webarchive": "trawl.sources.archives:web_archive",
    "commoncrawl": "trawl.sources.archives:crawl_archive",
    "corpus": "trawl.sources.simple:corpus",
    "url": "trawl.sources.simple:fetched",
    "oai": "trawl.sources.simple:oai_records",
    "wikidata": "trawl.sources.simple:entities",
    "metadata": "trawl.sources.simple:metadata",
    "table": "trawl.sources.simple:table",
}
#: Sources whose rows need no parsing.
PARSED = frozenset({"metadata"})


def load_source(name: str) -> Callable[..., DataFrame]:
    """A source by its name, or by "module:function" or a dotted path."""
    path = NAMES.get(name, name)
    module, _, attribute = path.partition(":") if ":" in path else path.rpartition(".")
    if not module:
        raise ValueError(f"no source called {name!r}; known: {sorted(NAMES)}")
    return getattr(importlib.import_module(module), attribute)


def read(spark: SparkSession, name: str, args: dict) -> DataFrame:
    return load_source(name)(spark, **args)


def per_source(df: DataFrame, maxdocs: int | str | None) -> DataFrame:
    """At most `maxdocs` rows of each source file, the first ones."""
    if maxdocs is None:
        return df
    nth = F.row_number().over(Window.partitionBy("source_path").orderBy("pos"))
    return df.withColumn("_nth", nth).where(F.col("_nth") <= int(maxdocs)).drop("_nth")


def later_wins(sources: list[DataFrame], key: str = "id") -> DataFrame:
    """The union of sources; of rows with one key the last source's stays.

    Of a source's own rows with one key, the one of the greatest hash stays, so that
    the choice doesn't hang on their order.
    """
    rows = None
    for n, df in enumerate(sources):
        own = df.withColumn("_n", F.lit(n))
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    hashed = [F.col(name) for name, kind in rows.dtypes if "map<" not in kind]
    last = F.max_by(F.struct(*[F.col(name) for name in rows.columns if name != "_n"]), F.struct("_n", F.xxhash64(*hashed)))
    return rows.groupBy(F.col(key).alias("_key")).agg(last.alias("_row")).select("_row.*")
