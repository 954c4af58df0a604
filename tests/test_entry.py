"""The entry file with and without the training-data subpackage and the pipeline file."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
WITHOUT = """
import importlib.abc, sys

class Absent(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name == "pluvia.llm" or name.startswith("pluvia.llm."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Absent())
"""


def run(code: str) -> str:
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    return done.stdout.strip()


def test_entry_imports_without_the_subpackage():
    out = run(WITHOUT + "import __spark_entry__ as E; from pluvia.plans import catalog\n"
              "print(set(E.queries()) == set(catalog.QUERIES), set(E.oracle_sql()) == set(catalog.ORACLE))")
    assert out == "True True"


def test_a_copy_without_the_two_folders_works(tmp_path):
    """The folders are really gone, corpus_pipeline.py stays, as a driver may leave them."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [
        n for n in names if n in (".git", "__pycache__", "llm", "spark-warehouse")])
    code = ("import __spark_entry__ as E; from pluvia.plans import catalog\n"
            "print(E.__file__, set(E.queries()) == set(catalog.QUERIES), set(E.oracle_sql()) == set(catalog.ORACLE))")
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert done.stdout.split() == [str(copy / "__spark_entry__.py"), "True", "True"], done.stderr[-2000:]
    done = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q"], cwd=copy,
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stdout[-2000:]


def test_the_rest_does_not_import_the_subpackage():
    out = run("import sys\nfrom pluvia.plans import catalog, daily\nfrom pluvia.streaming import ingest\n"
              "print(any(m.startswith('pluvia.llm') or m == 'corpus_pipeline' for m in sys.modules))")
    assert out == "False"


def test_an_error_inside_the_subpackage_is_not_hidden():
    code = WITHOUT.replace('name == "corpus_pipeline" or name == "pluvia.llm" or name.startswith("pluvia.llm.")',
                           'name == "xxhash"') + "import __spark_entry__"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    present = (ROOT / "pluvia" / "llm" / "simhash.py").exists()
    assert (done.returncode != 0) == present
