"""Time the headline queries; prints one JSON line.

Every query starts from the given tables and runs cold: stages are written anew, nothing is
shared between queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from premiere import queries as registered
from premiere.session import local_session

HEADLINE = (
    "order_lines_from_orders",
    "launch_month_demand",
    "product_history",
    "category_demand",
    "eligible_customers",
    "earlier_launch_stats",
    "similar_products_topk",
    "feature_matrix",
    "new_product_features",
    "title_features",
    "transaction_features",
    "roc_auc",
    "forecast_metrics",
    "fraud_scores",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()
    all_queries, seconds = registered.queries(), {}
    for name in HEADLINE:
        registered.forget_stages()
        start = time.time()
        all_queries[name](spark, folder).write.mode("overwrite").format("noop").save()
        seconds[name] = round(time.time() - start, 2)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 2)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
