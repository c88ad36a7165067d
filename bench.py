"""Benchmark: headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each timed job runs to completion through the ``noop`` sink (full execution,
nothing collected to the driver).  Inputs a job only reads (the stored flat
and wide tables of an increment) are written first and not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from chartfold.operators.upsert import change_order, upsert_by_key  # noqa: E402
from chartfold.plans import incremental as incr  # noqa: E402
from chartfold.plans.flatten import flatten_appointments, flatten_observations, flatten_patient_program  # noqa: E402
from chartfold.plans.pivot import WIDE_THRESHOLD, PivotSpec, build_catalog, widen  # noqa: E402
from chartfold.plans.refresh import WideStore  # noqa: E402
from chartfold.queries import AS_OF, INCR_T1, UPSERT_T, materialize, source  # noqa: E402
from chartfold.session import build_session, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "1"))
# n_concepts giving about 62, 250 and 1000 wide columns
WIDTHS = {"62": 25, "250": 112, "1000": 446}


def run(df):
    df.write.format("noop").mode("overwrite").save()


def timed(fn):
    best = None
    for _ in range(REPEAT):
        t0 = time.perf_counter()
        fn()
        dt = time.perf_counter() - t0
        best = dt if best is None else min(best, dt)
    return round(best, 3)


def main():
    spark = build_session(f"local[{CPUS}]", app="chartfold-bench", shuffle_partitions=int(CPUS) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    q = {}
    src = source(spark, SF_DIR)
    # warm-up: JVM, parquet footers, codegen caches
    run(flatten_observations(source(spark, SF_DIR).at(INCR_T1).tables()).limit(1000))

    q["flatten_observations"] = timed(lambda: run(flatten_observations(src.tables())))
    q["flatten_appointments"] = timed(lambda: run(flatten_appointments(src.tables(), as_of=AS_OF)))
    q["flatten_patient_program"] = timed(lambda: run(flatten_patient_program(src.tables(), as_of=AS_OF)))

    def full_build(n_concepts=25, strategy="auto"):
        s = source(spark, SF_DIR, n_concepts=n_concepts)
        flat = materialize(flatten_observations(s.tables()), "bench_flat")
        run(widen(flat, PivotSpec(), strategy=strategy))
    q["full_build_cold"] = timed(full_build)
    q["full_build_warm"] = timed(full_build)

    for width, n in WIDTHS.items():
        flat = materialize(flatten_observations(source(spark, SF_DIR, n_concepts=n).tables()), f"bench_flat_{width}")
        ncols = len(build_catalog(flat))
        for strategy in ("conditional", "long"):
            if width == "1000" and strategy == "conditional" and os.environ.get("BENCH_SKIP_WIDE_CONDITIONAL"):
                continue
            q[f"widen_{width}_{strategy}"] = timed(lambda: run(widen(flat, PivotSpec(), strategy=strategy)))
        q[f"widen_{width}_columns"] = ncols
        chosen = "long" if ncols > WIDE_THRESHOLD else "conditional"     # what strategy="auto" runs
        if f"widen_{width}_{chosen}" in q:
            q[f"widen_{width}_auto"] = q[f"widen_{width}_{chosen}"]

    # touched-mode increment of ~1% of obs vs a full rebuild of the same state, both
    # writing the stored flat + wide tables (partition-local rewrite for the increment)
    old = src.at(INCR_T1).tables()
    merged = incr.ingest(old, src.tables(), INCR_T1)
    raw = src.tables()
    for name in ("obs", "encounter", "visit"):   # the ingest step writes the raw tables (untimed)
        raw[name] = materialize(merged[name], f"bench_raw_{name}")
    store = WideStore(spark, root=scratch_path(spark, "bench-store"))
    store.build_full(old)
    info = {}
    q["increment_touched_1pct"] = timed(lambda: info.update(store.increment(raw, INCR_T1)))
    q["increment_partitions_rewritten"] = len(info.get("partitions", []))
    q["rebuild_full"] = timed(lambda: WideStore(spark, root=scratch_path(spark, "bench-full")).build_full(raw))
    q["increment_to_rebuild_ratio"] = round(q["increment_touched_1pct"] / q["rebuild_full"], 3)

    # key-merge of a ~10% batch into raw obs
    stored = materialize(src.at(UPSERT_T).table("obs"), "bench_obs_stored")
    batch = materialize(incr.changed_rows(src.table("obs"), UPSERT_T), "bench_obs_batch")
    q["upsert_10pct"] = timed(lambda: run(upsert_by_key(stored, batch, ["obs_id"], order_by=change_order(batch),
                                                                 null_safe=False)))

    # the headline value sums the jobs the system runs; the other pivot plan is for comparison
    headline = ["flatten_observations", "flatten_appointments", "flatten_patient_program", "full_build_warm",
                *[f"widen_{w}_auto" for w in WIDTHS], "increment_touched_1pct", "upsert_10pct"]
    total = round(sum(q[k] for k in headline if k in q), 3)
    sf = os.path.basename(SF_DIR).replace("sf", "")
    print(json.dumps({"metric": "total_job_seconds", "value": total, "unit": "sec", "value_sums": headline,
                      "queries": q,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": int(CPUS)}))
    spark.stop()


if __name__ == "__main__":
    main()
