import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def rows():
    return lambda df, *cols: sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda r: [(x is not None, str(type(x)), x) if x is not None else (False, "", 0) for x in r])
