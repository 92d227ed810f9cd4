"""The entry module without the training-data subpackage, and without a library it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import sys; sys.path.insert(0, {root!r}); {before}; import __spark_entry__ as e; from cellroll.queries.registry import QUERIES; print(set(QUERIES) <= set(e.queries()), any(n.startswith('op') or n == 'pipeline' for n in e.queries()))"


def run(before, root=ROOT):
    out = subprocess.run([sys.executable, "-c", NAMES.format(root=root, before=before)], capture_output=True, text=True, cwd=root)
    return out.stdout.split() or out.stderr


@pytest.mark.parametrize("missing", ["cellroll.llm", "public_tokenizers", "tokenizers", "sentencepiece"])
def test_core_queries_without(missing):
    assert run(f"sys.modules[{missing!r}] = None") in (["True", "False"], ["True", "True"])
    if missing in ("cellroll.llm", "public_tokenizers"):
        assert run(f"sys.modules[{missing!r}] = None") == ["True", "False"]


@pytest.mark.parametrize("pipeline", [True, False])
def test_core_queries_with_the_folder_gone(tmp_path, pipeline):
    """The subpackage's folder is absent; corpus_pipeline.py is there or went with it."""
    for name in os.listdir(ROOT):
        if name.endswith(".py") and (pipeline or name != "corpus_pipeline.py"):
            os.symlink(f"{ROOT}/{name}", tmp_path / name)
    # sys.path[0] of the entry follows the link's own name, so the package is linked member by member
    os.mkdir(tmp_path / "cellroll")
    for name in os.listdir(f"{ROOT}/cellroll"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/cellroll/{name}", tmp_path / "cellroll" / name)
    assert run("pass", str(tmp_path)) == ["True", "False"]
