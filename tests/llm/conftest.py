import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from llm_rows import ODD, make  # noqa: E402


@pytest.fixture
def odd(spark):
    return make(spark, ODD)


@pytest.fixture
def none(spark):
    return make(spark, [])
