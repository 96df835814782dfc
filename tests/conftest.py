import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

RAW_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("equipment_id", T.StringType()),
    T.StructField("equipment_type", T.StringType()),
    T.StructField("health_score", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("vibration", T.DoubleType()),
    T.StructField("power_consumption", T.DoubleType()),
    T.StructField("is_anomaly", T.IntegerType()),
    T.StructField("anomaly_reason", T.StringType()),
    T.StructField("load_timestamp", T.TimestampNTZType()),
    T.StructField("event_id", T.LongType()),
])


@pytest.fixture(scope="session")
def spark():
    from millstat.session import local_session

    s = local_session(shuffle_partitions=8, app="millstat-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millstat-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="millstat-test-")


def raw_row(**kw):
    base = dict(timestamp=dt.datetime(2024, 1, 1, 10, 0), equipment_id="Motor_001", equipment_type="Motor",
                health_score=90.0, temperature=45.0, vibration=2.5, power_consumption=8.5, is_anomaly=0,
                anomaly_reason=None, load_timestamp=dt.datetime(2024, 1, 2, 0, 0), event_id=0)
    base.update(kw)
    return tuple(base[f.name] for f in RAW_SCHEMA.fields)


def make_raw(spark, rows):
    return spark.createDataFrame([raw_row(**r) for r in rows], RAW_SCHEMA)
