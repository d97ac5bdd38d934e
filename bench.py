"""Time the headline queries; prints one JSON line.

Every result is written in full to a sink that discards it, so all columns of all
rows are computed and nothing passes through the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

from balcao.plans import catalog
from balcao.session import local_session

HEADLINE = [
    "gold_ticket_medio",
    "gold_descontos",
    "gold_historico_cliente_produtos",
    "gold_historico_cliente_volume",
    "gold_produtos_associados",
    "gold_historico_cliente_metricas",
    "dq_historico_volume",
    "dq_historico_metricas",
    "assoc_stats",
    "cart_suggestions_ranked",
    "sugestoes_contexto",
    "ofertas_mes",
    "status_enriquecido",
    "volume_9m",
    "acoes_ranked",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    # Start the executors and the readers outside the measured time.
    spark.read.parquet(f"{folder}/region.parquet").count()
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.run(name, spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
