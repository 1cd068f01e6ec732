import pytest


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    """Staged tables go to a folder of the test run unless the session names one."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
