import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dataprism.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", conf={"spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


def collect_dicts(df, order=None):
    rows = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        rows.sort(key=lambda r: tuple((r[k] is None, r[k]) for k in order))
    return rows
