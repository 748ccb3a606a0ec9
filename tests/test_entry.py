"""The entry imports, and the other queries are listed, when the training-data parts are gone."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from scorelake.queries import QUERIES

ROOT = Path(__file__).resolve().parent.parent
LIST = "import __spark_entry__ as e; print('NAMES', *e.queries()); print('SQL', *e.oracle_sql())"


def copy(to: Path, *without: str) -> Path:
    for part in ("scorelake", "tests", "__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / part).is_dir():
            shutil.copytree(ROOT / part, to / part, ignore=shutil.ignore_patterns("__pycache__"))
        elif (ROOT / part).exists():
            shutil.copy(ROOT / part, to / part)
    for part in without:
        shutil.rmtree(to / part, ignore_errors=True)
        if (to / part).is_file():
            (to / part).unlink()
    return to


def listed(folder: Path) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-B", "-c", LIST], cwd=folder, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize(
    "without",
    [("scorelake/llm", "tests/llm"), ("scorelake/llm", "tests/llm", "corpus_pipeline.py"), ("scorelake/llm/queries.py",)],
)
def test_the_rest_works_without_the_subpackage(tmp_path, without):
    done = listed(copy(tmp_path, *without))
    assert done.returncode == 0, done.stderr
    names = done.stdout.splitlines()[0].split()[1:]
    assert sorted(names) == sorted(QUERIES)


def test_a_leftover_folder_is_no_package(tmp_path):
    folder = copy(tmp_path, "scorelake/llm", "tests/llm")
    (folder / "scorelake/llm/__pycache__").mkdir(parents=True)
    assert listed(folder).returncode == 0


def test_other_import_errors_are_raised(tmp_path):
    folder = copy(tmp_path, "scorelake/llm", "tests/llm", "corpus_pipeline.py")
    (folder / "scorelake/llm").mkdir()
    (folder / "scorelake/llm/__init__.py").write_text("")
    (folder / "scorelake/llm/queries.py").write_text("import no_such_module\n")
    done = listed(folder)
    assert done.returncode and "no_such_module" in done.stderr
