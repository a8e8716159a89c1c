"""Per-stage wall clock of the pipeline's headline stages.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line.  Like the reference pipeline, stages hand over
through parquet: ``bind`` materialises the option table once (in the
session's shared checkpoint folder), later stages read it; customer and
option features are written as stages and joined by ``combine``.  Every
stage is fully executed; value = sum of the stage times.  ``segments`` removes
outliers before it fits; ``ranker_2_rounds`` are two boosting rounds over all options.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from faresight import get_session  # noqa: E402
from faresight.session import scratch_path  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                        extra={"spark.driver.memory": "8g"})
    from faresight.operators import metrics, profile, split
    from faresight.operators.combine import combine
    from faresight.operators.customers import customer_features
    from faresight.operators.options import option_features
    from faresight.plans.catalog import price_rank_scored_from
    from faresight.sources.binding import candidates
    from faresight.sources.store import write_stage

    timings = {}

    def run(stage, fn):
        t = time.time()
        fn()
        timings[stage] = round(time.time() - t, 3)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    cand_p, cust_p, opt_p = (scratch_path(spark, n) for n in ("candidates", "customers", "options"))
    run("bind", lambda: write_stage(candidates(spark, sf_dir), cand_p))
    cand = spark.read.parquet(cand_p)
    run("profile", lambda: noop(profile.missing_profile(cand)))
    run("split", lambda: noop(split.split_distribution(cand)))
    run("customer_features", lambda: write_stage(customer_features(cand), cust_p))
    run("option_features", lambda: write_stage(option_features(cand), opt_p))
    run("combine", lambda: noop(combine(spark.read.parquet(opt_p), spark.read.parquet(cust_p))))
    run("hit_rate", lambda: noop(metrics.hit_rate_at_k(price_rank_scored_from(cand), k=3)))
    from faresight.operators.iforest import remove_outliers
    from faresight.operators.lambdamart import train_lambdamart
    from faresight.plans.catalog import OUTLIER_SHARE, segment_customers
    run("outliers", lambda: noop(remove_outliers(spark.read.parquet(cust_p), OUTLIER_SHARE)[1]))
    if os.environ.get("BENCH_SEGMENTS", "1") == "1":
        run("segments", lambda: noop(segment_customers(spark.read.parquet(cust_p))))
    if os.environ.get("BENCH_RANKER", "1") == "1":
        run("ranker_2_rounds", lambda: train_lambdamart(spark.read.parquet(opt_p), rounds=2))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "stage_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf}))


if __name__ == "__main__":
    main()
