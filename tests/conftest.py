import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ringcast.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", "ringcast-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def feeds(spark, sf):
    """Feeds with every source staged, so that tests do not rebuild them."""
    import dataclasses

    from ringcast.plans.features import Feeds
    from ringcast.plans.testdata import KEPT, RawTables
    from ringcast.session import stage

    made = Feeds.read(spark, RawTables(spark, sf), KEPT)
    return dataclasses.replace(
        made, **{f.name: stage(getattr(made, f.name), f.name) for f in dataclasses.fields(made)}
    )
