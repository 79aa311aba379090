import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from siltbed.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", **{
            "spark.sql.shuffle.partitions": "3",
            "spark.driver.memory": "4g",
            # Tiny inputs: compiling plans would take longer than running them.
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1 -XX:ReservedCodeCacheSize=256m",
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            # Local files without checksum twins: half the file creations.
            "spark.hadoop.fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")
