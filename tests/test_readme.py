"""The README usage example runs as written."""

import os
import re

import pytest

from conftest import SF001
from tableguard.operators.results import StopOnFailure


def test_readme_example_runs(spark, scratch):
    for t in ("orders", "customer"):
        spark.read.parquet(f"{SF001}/{t}.parquet").createOrReplaceTempView(t)
    readme = open(os.path.join(os.path.dirname(os.path.dirname(__file__)), "README.md")).read()
    code = re.search(r"```python\n(.*?)```", readme, re.S).group(1)
    # first run: no history yet
    code = code.replace("history = R.read_results(spark, RESULTS_PATH)", "history = None")
    env = {"spark": spark, "RESULTS_PATH": os.path.join(scratch, "dq_results")}
    with pytest.raises(StopOnFailure):   # the day_to_day rule marked stop_on_failure fails here
        exec(code, env)
    assert env["done"].count() > 0
