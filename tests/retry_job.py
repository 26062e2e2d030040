"""Run under a retrying local master: tasks that fail once must not change any result.

Invoked by tests/test_retry.py in its own process (the master is fixed per JVM). A task
of partition 0 raises on its first attempt, before the paging shuffle and again after the
frozen numbering, as a lost executor would make Spark rerun it.
"""

import json
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from domus.operators import search  # noqa: E402
from domus.plans import derive  # noqa: E402
from domus.session import get_session  # noqa: E402
from domus.sources.tables import read_table  # noqa: E402


def fail_first_attempt(x):
    ctx = TaskContext.get()
    if ctx is not None and ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task loss")
    return True


def main() -> None:
    spark = get_session("local[2,4]", app="domus-retry", **{"spark.sql.shuffle.partitions": "4"})
    spark.sparkContext.setLogLevel("OFF")
    flaky = F.udf(fail_first_attempt, "boolean")
    n = 2000
    df = (spark.range(0, n, numPartitions=3).select(F.col("id").alias("k"), (F.col("id") % 13).alias("ts"))
          .filter(flaky(F.col("k"))))
    paged = search.paginate(df, "ts", "k", max_items=50, partitions=6).filter(flaky(F.col("k")))
    got = {r["k"]: [r["page_no"], r["pos"]] for r in paged.collect()}
    ranked = sorted(((i % 13, i) for i in range(n)), reverse=True)
    want = {k: [i // 50 + 1, i % 50] for i, (_, k) in enumerate(ranked)}

    li = read_table(spark, sys.argv[1], "lineitem").filter(flaky(F.col("l_orderkey")))
    sent = derive.versions_from_lineitem(li)
    again = sent.groupBy("page_date", "page_no", "pos", "value").count().filter("count > 1").count()
    print(json.dumps({"paging_ok": got == want, "messages": sent.count(), "lineitem_rows": li.count(), "repeated": again}))
    spark.stop()


if __name__ == "__main__":
    main()
