"""Time the headline queries; prints one JSON line.

The marts are rebuilt from the raw exports and published once, which is timed as
``full_rebuild``; reports then read the published tables, as they would in production.
Operators that work on raw exports are timed from the raw exports.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallystone.catalog import QUERIES, Book, published_marts  # noqa: E402
from tallystone.session import build_session  # noqa: E402

FROM_RAW = ["txn_parsed", "txn_flags", "txn_resolved", "txn_audit", "org_conformed",
            "facility_clean", "facility_audit", "file_provenance"]
ON_MARTS = ["fact_upsert", "running_balance", "nfe_movement", "total_outstanding",
            "outstanding_by_status", "top_borrowers", "monthly_remittances",
            "exposure_by_industry", "investor_summary", "recon_checks", "api_loan",
            "portfolio_summary", "remittance_intake"]
STREAM = ["stream_incremental"]


def timed(action):
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name):
        QUERIES[name](Book(spark, sf_dir)).write.format("noop").mode("overwrite").save()

    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {"full_rebuild": timed(lambda: published_marts(Book(spark, sf_dir)))}
    for name in [*FROM_RAW, *ON_MARTS, *STREAM]:
        seconds[name] = timed(lambda: run(name))
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
