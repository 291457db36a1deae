import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shelfcast.session import get_session

    s = get_session("local[4]", 4, app_name="shelfcast-tests")
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def TS(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)
