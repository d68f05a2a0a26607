import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillstream import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    options = {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        # Tests run each plan once: compile quickly rather than well.
        "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    spark = session.build("tests", "local[4]", **options)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
