"""Times the headline queries; prints one JSON line.

Each query runs once to warm up (code generation, JIT) and then ``BENCH_RUNS`` times; the
best time counts. ``naive`` holds the same results computed the plain way: one job per column
for nulls, a fresh scan for each of six evaluator calls.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from duelist.operators import decision
from duelist.plans import fixtures as fx
from duelist.plans.queries import LABEL, QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
HEADLINE = os.environ.get("BENCH_QUERIES", "").split() or [
    "null_profile", "split_counts", "group_counts", "auc_by_group", "confusion_by_group", "f1_by_group",
    "ab_report", "ab_decision", "ab_report_by_period", "slice_metrics", "ztest_auc", "bootstrap_accuracy",
    "bootstrap_auc", "shuffle_rows", "standardise", "resolve_alias", "register_version", "promote",
    "train_rf", "score_champion_challenger",
]


def naive_null_profile(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    df = documents.join(fx.table(spark, sf_dir, "labels"), "doc_id", "left")
    return df.count(), [df.filter(F.col(c).isNull()).count() for c in df.columns]


def naive_ab_report(spark, sf_dir):
    scored = fx.scored_transactions(spark, sf_dir)
    auc = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="score", numBins=0)
    others = [MulticlassClassificationEvaluator(labelCol=LABEL, metricName=m) for m in ("accuracy", "f1")]
    out = [scored.groupBy("ab_group").count().collect()]
    for group in (decision.CHAMPION, decision.CHALLENGER):
        part = scored.filter(F.col("ab_group") == group)
        out += [e.evaluate(part) for e in (auc, *others)]
    return out


NAIVE = {"null_profile": naive_null_profile, "ab_report": naive_ab_report}


def best(run) -> float:
    run()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {}
    for name in HEADLINE:
        # noop writes compute every row without bringing any to the driver
        queries[name] = best(lambda q=QUERIES[name]: q(spark, SF_DIR).write.format("noop").mode("overwrite").save())
    naive = {name: best(lambda f=f: f(spark, SF_DIR)) for name, f in NAIVE.items() if name in queries}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(queries.values()), 3), "unit": "sec",
        "queries": queries, "naive": naive, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": CPUS,
    }))


if __name__ == "__main__":
    main()
