"""Wall times of the headline jobs, printed as one JSON line.

Stores and the index are written first; what is timed is planning plus ``collect``. ``exact_N`` are the
``build_index``, which runs once.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from recallset.operators import mutate  # noqa: E402
from recallset.operators.search import search, search_hits, search_one  # noqa: E402
from recallset.plans import ivf  # noqa: E402
from recallset.registry import fixtures as fx  # noqa: E402
from recallset.registry import queries as rq  # noqa: E402
from recallset.session import builder, scratch_path  # noqa: E402
from recallset.sources.store import read_store, write_snapshot  # noqa: E402
from recallset.spec import IndexSpec  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("recallset-bench")
        .master(f"local[{cpus}]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spec = fx.SPEC
    times: dict[str, float] = {}

    def timed(name: str, job: Callable[[], DataFrame], runs: int = 3) -> None:
        for _ in range(runs):
            start = time.perf_counter()
            job().collect()
            taken = round(time.perf_counter() - start, 3)
            times[name] = min(times.get(name, taken), taken)

    path = scratch_path(spark, "bench")
    write_snapshot(fx.shared_store(spark, sf_dir), f"{path}/store", spec)
    items = fx.items(spark, sf_dir)
    items.write.parquet(f"{path}/items")
    store, items = read_store(spark, f"{path}/store", spec), spark.read.parquet(f"{path}/items")
    queries = fx.vector_queries(spark, sf_dir)
    scoped = fx.scoped_queries(spark, sf_dir)
    mean = fx.mean_vector(spark, sf_dir)

    timed("count_owned", lambda: mutate.count(store, spec))
    timed("get_batch", lambda: mutate.get(store, fx.ids(spark, sf_dir), spec))
    timed("upsert_batch", lambda: mutate.upsert(store, items, spec, fx.WRITTEN).rows)
    timed("clear_owned", lambda: mutate.clear(store, spec))
    timed("topk_single", lambda: search_one(store, mean, spec))
    timed("topk_single_builtin", lambda: search_one(store, mean, spec, builtin=True))
    for n in (20, 200, 2000):
        some = queries.filter(F.col("q_id") < n)
        timed(f"exact_{n}", lambda some=some: search_hits(store, some, spec).rows)
    timed("exact_2000_shuffled", lambda: search_hits(store, queries, spec, method="shuffle").rows)
    timed("filter_per_query", lambda: search_hits(store, scoped, spec).rows)
    timed("search_full", lambda: search(store, scoped, spec))

    index_spec = IndexSpec(spec, description="IVF16,SQ8")
    start = time.perf_counter()
    index = ivf.build_index(store, index_spec, f"{path}/index")
    times["build_index"] = round(time.perf_counter() - start, 3)
    timed("ivf_probe", lambda: ivf.search_index_hits(index, queries, n_probes=4).rows)
    timed(
        "ivf_rerank",
        lambda: ivf.search_index_hits(index, queries, n_probes=4, rerank=True, top_n_scan=50).rows,
    )
    for name in ("embed_keyword_count", "retrieve", "memory_recall", "stream_ingest"):
        timed(name, lambda name=name: rq.QUERIES[name](spark, sf_dir))

    line = {
        "metric": "total wall time of the headline jobs",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
