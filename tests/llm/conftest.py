from __future__ import annotations

import pytest

from eventloom.llm.staging import prepare


@pytest.fixture(autouse=True)
def _package_on_executors(spark):
    prepare(spark)
