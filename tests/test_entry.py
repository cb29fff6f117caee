"""The entry module without the training-data operators, or without a library that only they need."""

import subprocess
import sys

from valuepay.queries import registered

ROOT = __file__.rsplit("/tests/", 1)[0]
BLOCK = """
import importlib.abc, sys
class Block(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Block())
sys.path.insert(0, {root!r})
import __spark_entry__ as E
print(sorted(E.queries()) == {want!r}, set(E.oracle_sql()) <= set(E.queries()))
"""


def test_entry_without_the_operators_or_their_libraries():
    for name in ("valuepay.llm", "corpus_pipeline", "public_tokenizers"):
        code = BLOCK.format(name=name, root=ROOT, want=sorted(registered()))
        done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True, text=True, timeout=120)
        assert done.stdout.split() == ["True", "True"], done.stderr
