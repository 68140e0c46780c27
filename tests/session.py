from __future__ import annotations

from tidemark.session import build_session


def test_session():
    spark = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


test_session.__test__ = False
