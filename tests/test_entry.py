import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
SCRIPT = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'classify_exhibitor' in q, [n for n in q if n.startswith('op') or n == 'pipeline'])"


def _names(folder: Path) -> str:
    return subprocess.run([sys.executable, "-c", SCRIPT], cwd=folder, capture_output=True, text=True, check=True).stdout


def test_entry_without_the_add_on(tmp_path):
    for n, left_out in enumerate((("llm",), ("llm", "corpus_pipeline.py"))):
        folder = tmp_path / str(n)
        shutil.copytree(REPO, folder, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests", *left_out))
        count, there, add_on = _names(folder).split(maxsplit=2)
        assert int(count) > 90 and there == "True" and add_on.strip() == "[]"
