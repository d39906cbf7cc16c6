import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
#: Imports the entry points where some modules are not there, and counts the training-data queries.
CODE = """
import sys
gone = set(sys.argv[1].split(","))

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in gone:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
names = entry.queries()
entry.oracle_sql()
print(sum(n.startswith("op") for n in names), "pipeline" in names)
"""


HERE = (ROOT / "claimwright/llm").exists()


def imported(gone):
    return subprocess.run([sys.executable, "-c", CODE, gone], cwd=ROOT, capture_output=True, text=True)


@pytest.mark.parametrize("gone, want", [("", "13 True" if HERE else "0 False"), ("claimwright.llm", "0 False"), ("corpus_pipeline", "13 False" if HERE else "0 False"), ("claimwright.llm,corpus_pipeline", "0 False")])
def test_folders_that_may_be_absent(gone, want):
    assert imported(gone).stdout.strip() == want


@pytest.mark.skipif(not HERE, reason="no training-data operators")
@pytest.mark.parametrize("gone", ["xxhash", "regex", "claimwright.llm.simhash"])
def test_a_missing_dependency_is_no_absent_folder(gone):
    out = imported(gone)
    assert out.returncode and f"No module named '{gone}'" in out.stderr
