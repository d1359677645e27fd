"""The registered queries must load without the training-data operators."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys

class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("episodica.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
names = entry.queries()
assert len(names) > 150 and not any(n.startswith("op1") or n == "pipeline" for n in names)
assert set(entry.oracle_sql()) <= set(names)
"""


def test_without_training_data_operators():
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", SCRIPT], cwd=root, check=True, timeout=120)
