"""The entry module with parts left out: the other queries stay."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

PROBE = """
import sys
from importlib.abc import MetaPathFinder


class Absent(MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name}}", name=name)


sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry

print(len([q for q in entry.queries() if not q.startswith("op") and q != "pipeline"]))
print(len([q for q in entry.queries() if q.startswith("op") or q == "pipeline"]))
print(set(entry.oracle_sql()) <= set(entry.queries()))
"""


@pytest.mark.parametrize("names", [{"ahocorasick"}, {"xxhash"}, {"loadcast.llm"}, {"corpus_pipeline"}])
def test_entry_without(names):
    from checks.queries import QUERIES

    run = subprocess.run(
        [sys.executable, "-c", PROBE.format(names=names)], cwd=ROOT, capture_output=True, text=True, timeout=300
    )
    assert run.returncode == 0, run.stderr
    core, llm, known = run.stdout.split()
    assert int(core) == len(QUERIES) and known == "True"
    assert (int(llm) == 0) == (names != {"corpus_pipeline"}) or not (ROOT / "loadcast" / "llm").exists()
