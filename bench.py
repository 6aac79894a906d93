"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from pageloom.operators.parse import build_pages
from pageloom.plans import corpus
from pageloom.plans.queries import queries
from pageloom.session import local_session

# Parsing, conversion, links, graph and merges, and the whole import.
HEADLINE = (
    "pages_fields",
    "plain_text",
    "hidden_markup",
    "entities_decoded",
    "edges",
    "term_mentions",
    "resolved_links",
    "html_links",
    "import_tables",
)


def long_pages(spark, sf_dir: str, cpus: int) -> tuple[float, float]:
    """Seconds to convert pages that hold the whole documents, and MB of them per second and
    core: short pages mostly show what a row costs."""
    docs = corpus.read_table(spark, sf_dir, "documents").repartition(4 * cpus)
    raw = corpus.page_xml(
        docs.select(
            F.concat(F.lit("Document "), F.col("doc_id")).alias("title"),
            F.lit(corpus.FIXED_TIME).alias("timestamp"),
            F.col("text").alias("wikitext"),
            F.lit("documents.xml").alias("file"),
        )
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    start = time.perf_counter()
    build_pages(raw).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    return seconds, size / 1e6 / seconds / cpus


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "12g"))
    todo = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    # Start-up and code loading are not part of any query.
    queries()["pages_fields"](spark, sf_dir).limit(1).collect()
    for name in todo:
        start = time.perf_counter()
        queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    rate = None
    if not sys.argv[1:]:
        seconds["long_pages"], rate = (round(x, 3) for x in long_pages(spark, sf_dir, cpus))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "long_pages_mb_per_core_second": rate,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
