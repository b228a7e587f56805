import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rillmart import schemas  # noqa: E402
from rillmart.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session("local[4]", shuffle_partitions=4, spark__checkpoint__dir=str(folder),
                            spark__driver__memory="4g")
    yield session
    session.stop()


LOG_SCHEMA = "mid string, is_new string, page_id string, last_page_id string, ts bigint, event_id bigint"


@pytest.fixture(scope="session")
def make_log(spark):
    """Log records from (mid, ts, last_page_id[, is_new]) rows, numbered in the given order."""
    from pyspark.sql import functions as F

    def make(rows):
        full = [(r[0], r[3] if len(r) > 3 else "0", "p", r[2], r[1], i) for i, r in enumerate(rows)]
        flat = spark.createDataFrame(full, LOG_SCHEMA)
        none = F.lit(None).cast("string")
        return flat.select(
            F.struct("mid", F.lit("v1").alias("vc"), F.lit("c1").alias("ch"), F.lit("a1").alias("ar"), "is_new").alias(
                "common"),
            F.struct("page_id", "last_page_id", none.alias("item"), none.alias("item_type"),
                     F.lit(10).cast("bigint").alias("during_time")).alias("page"),
            F.lit(None).cast(schemas.PAGE_LOG["displays"].dataType).alias("displays"),
            none.alias("start"), "ts", "event_id")

    return make
