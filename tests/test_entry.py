"""The registry also without the training-data subpackage."""

import os
import subprocess
import sys

from tests.conftest import ROOT

BLOCKED = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("vintagecast.llm"):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert not any(k.startswith("op") or k == "pipeline" for k in e.queries()), list(e.queries())
assert len(e.queries()) >= 93 and set(e.oracle_sql()) <= set(e.queries())
"""


def test_entry_without_the_training_data_part():
    done = subprocess.run([sys.executable, "-c", BLOCKED], cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
