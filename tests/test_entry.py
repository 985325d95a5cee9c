"""The entry without the training-data operators or what they need."""

import os
import subprocess
import sys

from tests.conftest import ROOT

BLOCKED = """
import sys
sys.path.insert(0, {root!r})

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
names = set(e.queries())
assert len(names) >= 62 and "area_top3" in names and "pipeline" not in names and not any(n.startswith("op") for n in names), names
assert set(e.oracle_sql()) <= names
print("IMPORTED", len(names))
"""


def test_shop_queries_do_not_need_the_training_data_part():
    for name in ("shopflow.llm", "corpus_pipeline", "public_tokenizers", "regex"):
        done = subprocess.run([sys.executable, "-c", BLOCKED.format(root=ROOT, name=name)], capture_output=True, text=True, timeout=60,
                              env=os.environ | {"PYTHONPATH": ROOT})
        assert "IMPORTED" in done.stdout, done.stderr[-1500:]
        assert "left out" in done.stderr
