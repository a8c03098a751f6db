"""All registered queries next to their SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import compare  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
CHECKED = sorted(contract.oracle_sql())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    verdict, _ = compare.compare(
        spark, compare.connect(FOLDER), FOLDER, name, contract.queries()[name], contract.oracle_sql()[name]
    )
    assert verdict.startswith("ok"), verdict


def test_entry_and_registry(spark):
    assert contract.entry(spark).limit(1).count() == 1
    assert set(contract.oracle_sql()) <= set(contract.queries())
