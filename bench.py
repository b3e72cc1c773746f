"""Times the headline queries and prints one JSON line; one untimed run of the first query warms the JVM."""

from __future__ import annotations

import json
import os
import time

from sectoria.queries import REGISTRY
from sectoria.queries.sources import written_lines
from sectoria.session import local_session

HEADLINE = [
    "territory_scores",
    "age_scores",
    "city_pages",
    "sector_statistics",
    "commune_year_profile",
    "cube_base",
    "dominant_profile",
    "treemap",
    "located_persons",
    "search_table",
    "parsed_lines",
    "death_people",
    "yearly_refresh",
    "gated_rows",
    "yearly_ids",
    "global_positions",
    "quantile_classes",
    "city_days",
    "coverage_runs",
    "describe",
    "shapiro_statistics",
    "spearman_coefficients",
    "kendall_tests",
    "chi_square_statistics",
    "climate_tests",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores))
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run(HEADLINE[0])
    written_lines(spark, folder)  # input of several queries, not part of their time
    seconds = {name: run(name) for name in HEADLINE}
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
