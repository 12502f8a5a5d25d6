import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rivalry.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    extra = {}
    # Tests run locally: give the session its own checkpoint folder.
    extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = local_session(4, shuffle_partitions=4, app="rivalry-tests", extra=extra)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_spark(spark):
    from rivalry.session import work_dir
    return lambda name: work_dir(spark, name)


def games_df(spark, rows):
    from rivalry.schemas import GAMES
    import datetime as dt
    fixed = [(dt.date.fromisoformat(r[0]) if isinstance(r[0], str) else r[0], *r[1:]) for r in rows]
    return spark.createDataFrame(fixed, GAMES)
