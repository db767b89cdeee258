import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from geoscore.session import get_spark, work_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", 8, extra={"spark.driver.memory": "6g"})
    work_dir(s)  # session's checkpoint folder, or a fresh one when unset
    yield s
    s.stop()
