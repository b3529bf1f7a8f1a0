"""Every registered query of the engine against its SQL, and the driver contract."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as driver
import pytest
from compare import compare, connect

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(driver._QUERIES) == set(driver.ORACLES)
    assert set(driver._QUERIES) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(driver._QUERIES))
def test_query(spark, name):
    assert compare(spark, connect(SF), driver.queries()[name], driver.oracle_sql()[name], SF) is None


def test_entry_without_what_training_data_needs():
    """Where a library that only the training-data part uses is missing, all other queries are there."""
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e._QUERIES))"
    root = Path(driver.__file__).parent
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True).stdout.strip() == "True"
