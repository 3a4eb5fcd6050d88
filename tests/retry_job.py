"""Run the setup DAG with every first task attempt failing midway.

Usage: python tests/retry_job.py <landing base> <output root>
Runs in its own process because task retries need a ``local[N,F]`` master.
Prints the check rows as JSON.
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import DataFrame  # noqa: E402

import logtally.plans.setup as setup  # noqa: E402
from logtally.session import build_session  # noqa: E402
from logtally.sinks import versions  # noqa: E402


def _fail_first_attempt(batches):
    ctx = TaskContext.get()
    for i, pdf in enumerate(batches):
        if ctx.attemptNumber() == 0 and i == 0 and len(pdf) > 1:
            yield pdf.iloc[:1]                   # emit part of the partition, then die
            marker = os.path.join(os.environ["RETRY_MARKERS"],
                                  f"{ctx.stageId()}-{ctx.partitionId()}")
            open(marker, "w").close()
            raise RuntimeError("simulated executor loss")
        yield pdf


_scan = setup.scan_lines


def flaky_scan(spark, root, **options) -> DataFrame:
    df = _scan(spark, root, **options)
    return df.mapInPandas(_fail_first_attempt, df.schema)


if __name__ == "__main__":
    base, out = sys.argv[1], sys.argv[2]
    spark = build_session("retry", master="local[2,3]", shuffle_partitions=4,
                          extra={"spark.sql.execution.arrow.maxRecordsPerBatch": "2"})
    spark.sparkContext.setLogLevel("OFF")
    setup.scan_lines = flaky_scan
    cfg = setup.SetupConfig(raw_root=f"{base}/raw/metrics", clean_root=f"{base}/nom/clean",
                            output_root=out, recursive=True)
    results = setup.run_setup(spark, cfg, report=False)
    lines = versions.read(spark, cfg.path("raw", "lines")).count()
    print(json.dumps({"results": {k.rsplit("/", 2)[-2] + "/" + k.rsplit("/", 1)[-1]: v
                                  for k, v in results.items()}, "raw_lines": lines}))
    spark.stop()
