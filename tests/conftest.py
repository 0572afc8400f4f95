import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rivulet.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    ckpt = tmp_path_factory.mktemp("checkpoints")
    s = get_spark("rivulet-tests", master="local[4]", shuffle_partitions=4,
                  conf={"spark.checkpoint.dir": str(ckpt),
                        "spark.sql.streaming.noDataMicroBatches.enabled": "true"})
    yield s
    s.stop()
