"""The entry points without the text operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

PROBE = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("cartwheel.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
assert "basket_recommendations" in e.queries() and "pipeline" not in e.queries()
assert set(e.oracle_sql()) <= set(e.queries())
"""


def test_entry_points_import_without_the_text_operators():
    subprocess.run([sys.executable, "-c", PROBE], cwd=ROOT, check=True)


def test_nothing_else_imports_the_text_operators():
    for path in (ROOT / "cartwheel").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "cartwheel.llm" not in path.read_text(), path
