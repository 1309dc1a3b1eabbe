from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle

sys.path.insert(0, str(Path(__file__).parent.parent))

from goldleaf.session import CHECKPOINT_KEY, build  # noqa: E402

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            CHECKPOINT_KEY: str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def plan_of():
    def text(df) -> str:
        return df._jdf.queryExecution().toString()

    return text


class Script:
    """Client whose answers are listed per (record, agent), one per attempt."""

    def __init__(self, answers: dict, tokens: int = 100) -> None:
        self.answers = answers
        self.tokens = tokens

    def __call__(self):
        def call(row):
            answer = self.answers.get((row.record_id, row.agent), self.answers.get(row.agent))
            if isinstance(answer, list):
                answer = answer[row.attempt - 1]
            if isinstance(answer, Exception):
                raise answer
            return answer, self.tokens

        return call


@pytest.fixture()
def script():
    return Script
