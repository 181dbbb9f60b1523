import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import importlib.util, sys
sys.path.insert(0, sys.argv[1])
from leadframe.llm.queries import QUERIES
from leadframe.session import build_session
spark = build_session("workers", "local[4]", spark__sql__shuffle__partitions="4")
def there(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("leadframe") is not None])], ["there"])
assert not spark.range(1).mapInArrow(there, "there boolean").head().there
for name in sys.argv[3:]:
    QUERIES[name](spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
    print("done", name, flush=True)
"""


def test_executors_need_no_package(tmp_path, sf_dir):
    names = ["op1_pack_tokens", "op2_language", "op3_benchmark_leaks", "op5_html_text", "op10_licenses", "op11_line_dedup",
             "op12_prefix_trie", "op13_source_divergence"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    got = subprocess.run([sys.executable, str(script), REPO, sf_dir, *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert [line for line in got.stdout.splitlines() if line.startswith("done")] == [f"done {n}" for n in names], got.stderr[-2000:]
