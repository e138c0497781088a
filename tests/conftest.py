import pytest

from paperloom.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session(4, 4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.driver.memory": "4g"})
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
