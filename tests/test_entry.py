"""The driver contract without the optional text operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(folder):
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"],
                          cwd=folder, env={**os.environ, "PYTHONPATH": str(folder)}, capture_output=True, text=True, check=True)
    return [set(line.split()) for line in said.stdout.splitlines()[-2:]]


def _without_text_operators(to):
    """The repository as it is once both folders of the text operators are deleted."""
    shutil.copytree(os.path.join(ROOT, "tirepulse"), to / "tirepulse", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(os.path.join(ROOT, "tests"), to / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(os.path.join(ROOT, "tools"), to / "tools")
    for name in os.listdir(ROOT):
        if os.path.isfile(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), to)


def test_entry_works_without_the_text_operators(tmp_path):
    _without_text_operators(tmp_path)
    for pipeline in (True, False):
        queries, sql = _names(tmp_path)
        assert "sensor_issues" in queries and sql <= queries
        assert not any(q.startswith("op") or q == "pipeline" for q in queries)
        if pipeline:
            os.remove(tmp_path / "corpus_pipeline.py")
    os.makedirs(tmp_path / "tirepulse" / "llm" / "__pycache__")       # a leftover folder is no package
    assert _names(tmp_path) == [queries, sql]


def test_the_other_tests_can_be_collected_without_the_text_operators(tmp_path):
    _without_text_operators(tmp_path)
    said = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q"], cwd=tmp_path,
                          env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert said.returncode == 0, said.stdout[-2000:]


def test_entry_works_where_a_library_of_the_text_operators_is_missing(tmp_path):
    (tmp_path / "xxhash.py").write_text("raise ImportError('not here')")
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries()))"], cwd=tmp_path,
                          env={**os.environ, "PYTHONPATH": f"{tmp_path}:{ROOT}"}, capture_output=True, text=True, check=True)
    names = said.stdout.split()
    assert "sensor_issues" in names and "op1_decontamination" not in names


def test_nothing_else_imports_the_text_operators():
    for folder, _, names in os.walk(os.path.join(ROOT, "tirepulse")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    assert "tirepulse.llm" not in open(os.path.join(folder, name)).read(), name
