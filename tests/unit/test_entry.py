import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from tests.conftest import ROOT

CORPUS = "print(sorted(n for n in e.queries() if n[:2] == 'op' or n == 'pipeline'))"


def test_absent_module_has_no_queries():
    assert entry._optional("no_such_pipeline") is None


def test_missing_dependency_is_an_error(tmp_path, monkeypatch):
    pytest.importorskip("lakemart.llm")
    (tmp_path / "needs_more.py").write_text("import no_such_library\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    with pytest.raises(ModuleNotFoundError, match="no_such_library"):
        entry._optional("needs_more")


@pytest.mark.parametrize("left", [(), ("corpus_pipeline.py",), ("lakemart/llm/__pycache__",)])
def test_queries_without_the_subpackage(tmp_path, left):
    names = ("lakemart", "oracle", "__spark_entry__.py")
    for name in names:
        source, target = ROOT / name, tmp_path / name
        if source.is_dir():
            shutil.copytree(source, target, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, target)
    for name in left:
        if name.endswith(".py"):
            if not (ROOT / name).exists():
                pytest.skip("not installed")
            shutil.copy(ROOT / name, tmp_path / name)
        else:
            (tmp_path / name).mkdir(parents=True)
    code = f"import __spark_entry__ as e; assert e.__file__.startswith({str(tmp_path)!r}); {CORPUS}; print(len(e.queries()) > 50 and len(e.oracle_sql()) > 50)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.split("\n")[:2] == ["[]", "True"], done.stderr
