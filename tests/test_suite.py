"""The suite itself: every module is collected, with the corpus operators and without them."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("more", [[], ["--ignore=tests/llm"]])
def test_everything_is_collected(more):
    run = subprocess.run(
        [sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests", *more],
        cwd=ROOT, capture_output=True, text=True,
    )
    assert run.returncode == 0, run.stdout[-2000:]
    for module in ("test_oracle.py", "test_plans.py", "test_medallion.py"):
        assert module in run.stdout
