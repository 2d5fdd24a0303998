import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cartulary.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests")
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Apply a rule to a list of texts and return the results in order."""

    def run(texts, rule):
        rows = [(i, text) for i, text in enumerate(texts)]
        table = spark.createDataFrame(rows, "i int, text string").coalesce(1)
        found = table.select("i", rule.alias("result")).orderBy("i").collect()
        return [row.result for row in found]

    return run
