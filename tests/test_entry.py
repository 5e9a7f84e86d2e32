"""The entry module works without the text operators and without their libraries."""

import subprocess
import sys

import pytest

from conftest import ROOT

SCRIPT = """
import sys

class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == {hidden!r} or name.startswith({hidden!r} + "."):
            raise ModuleNotFoundError("hidden", name=name)

sys.meta_path.insert(0, Hidden())
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
names = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]
print(len(names), len(entry.queries()), set(names) <= set(entry.oracle_sql()))
"""


def run(hidden):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(hidden=hidden, root=ROOT)], capture_output=True, text=True)
    return done.returncode, done.stdout.split(), done.stderr


@pytest.mark.parametrize("library", ["ahocorasick", "auditmart.llm", "corpus_pipeline", "numpy"])
def test_reports_stay_without_a_library(library):
    from auditmart.queries import QUERIES

    code, out, err = run(library)
    assert code == 0, err
    assert out == [str(len(QUERIES)), str(len(QUERIES)), "True"]


def test_a_missing_report_module_is_an_error():
    code, _, err = run("auditmart.plans.waitlist")
    assert code != 0 and "waitlist" in err
