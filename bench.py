"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from microlake.plans.queries import QUERIES, new_silver, unified

BUILDS = {"build_silver": new_silver, "build_unified": unified}

HEADLINE = (
    "q_mensal", "q_lentes", "g_saldo_mensal", "g_perfil_demografico", "g_ti_setor_vs_ocupacao", "l_serie_longa_anual", "l_demografia_longa",
    "j1_translate_codes", "silver_full_market", "u1_unify_generations", "a11_history_arc", "t6_top_sectors", "w1_forward_fill", "w4_latest_per_key",
    "a3_plan_summary", "a17_coverage", "k1_k8_write_bronze",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="spark-")
    conf = {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC", "spark.local.dir": scratch, "spark.checkpoint.dir": f"file://{scratch}/shared",
    }
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["s11_row_count"](spark, sf_dir).collect()  # starts the JVM's threads
    times = {}
    for name, build in BUILDS.items():  # written once; what follows reads it
        began = time.perf_counter()
        build(spark, sf_dir)
        times[name] = round(time.perf_counter() - began, 3)
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
