"""Run entry() and one query of each catalog module on a session that the library did not build. Started by test_bare_session."""

import sys

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from millrace.catalog import load

SF = "/root/testdata/sf0.001"


def main(shared: str) -> None:
    spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", shared).getOrCreate()
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.forceOptimizeSkewedJoin", "spark.sql.shuffle.partitions")}
    assert entry.entry(spark).count() > 0
    first = {}
    for name, e in load().items():
        first.setdefault(e.build.__module__, name)
    for name in first.values():
        entry.queries()[name](spark, SF).count()
    assert before == {k: spark.conf.get(k, None) for k in before}
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert entry.queries()["status_duration"](spark, SF).sparkSession.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    print("bare session: ok", len(first))


if __name__ == "__main__":
    main(sys.argv[1])
