"""The driver contract without the training-data subpackage, and with a broken one."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BLOCKED = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[:len(GONE)] == GONE:
            raise ModuleNotFoundError(f'No module named {name!r}', name=MISSING or name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(len(e.queries()), any(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in e.queries()))
"""


def run(gone: str, missing: str = "") -> subprocess.CompletedProcess:
    code = f"GONE, MISSING = {gone.split('.')!r}, {missing!r}\n{BLOCKED}"
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_queries_without_the_subpackage():
    from apportion.plans import job_queries, queries

    core = {**queries.QUERIES, **job_queries.QUERIES}
    for gone in ("apportion.llm", "corpus_pipeline"):
        assert run(gone).stdout.split() == [str(len(core)), "False"]


@pytest.mark.skipif(not os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")), reason="the subpackage was taken away")
def test_other_import_errors_are_not_hidden():
    out = run("apportion.llm", "some_library")
    assert out.returncode and "ModuleNotFoundError" in out.stderr
