"""The entry point works without the optional subpackage and its pipeline."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
PROGRAM = """
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:{parts}] == {name!r}.split("."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
names = entry.queries()
assert "susceptibility_mart" in names and set(entry.oracle_sql()) <= set(names)
print(any(n.startswith("op1_") for n in names))
"""


def run(name):
    program = PROGRAM.format(name=name, parts=len(name.split(".")))
    return subprocess.run([sys.executable, "-c", program], cwd=ROOT, capture_output=True, text=True)


def test_without_the_subpackage():
    found = run("cohortgram.llm")
    assert found.returncode == 0 and found.stdout.split() == ["False"], found.stderr


@pytest.mark.parametrize("name", ["pyarrow", "cohortgram.operators"])
def test_other_missing_modules_are_errors(name):
    assert run(name).returncode != 0
