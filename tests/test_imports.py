import glob
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PLANS = sorted(os.path.basename(p)[:-3] for p in glob.glob(os.path.join(ROOT, "traceloom", "plans", "*.py")) if not p.endswith("__init__.py"))


@pytest.mark.parametrize("name", PLANS)
def test_each_plan_module_is_importable_alone(name):
    """As a Python worker does that unpickles one of its functions."""
    subprocess.run([sys.executable, "-c", f"import traceloom.plans.{name}"], cwd=ROOT, check=True, env=os.environ | {"PYTHONPATH": ROOT})
