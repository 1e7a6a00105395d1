import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from maskmetrics.operators.registry import SensitiveColumn, build_registry  # noqa: E402
from maskmetrics.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", 4, "tests")
    yield session
    session.stop()


@pytest.fixture
def registry_of(spark):
    """Build a dictionary from {category: [values]}."""
    def make(**categories):
        tables = {c: spark.createDataFrame([(v,) for v in values], "value string")
                  for c, values in categories.items()}
        return build_registry(spark, [SensitiveColumn(c, c, "value") for c in categories], tables)
    return make
