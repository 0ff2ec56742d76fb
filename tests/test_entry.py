import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

IMPORT = """
import sys
sys.path.insert(0, {root!r})
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {library!r} or name == {library!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
names = entry.queries()
assert "weekly_features" in names and not any(n.startswith("op") or n == "pipeline" for n in names)
assert set(entry.oracle_sql()) <= set(names)
"""

ELSEWHERE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.driver.host", "127.0.0.1").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", "file:{folder}/shared").getOrCreate())
import __spark_entry__ as entry
assert entry.queries()["correlation"](spark, "/root/testdata/sf0.001").count() == 6
"""


def run(code, folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=300)


@pytest.mark.parametrize("library", ["public_tokenizers", "tiktoken", "sentencepiece", "tokenizers",
                                     "corpus_pipeline", "demandloom.llm"])
def test_a_missing_library_leaves_only_the_text_queries_out(library, tmp_path):
    done = run(IMPORT.format(root=ROOT, library=library), tmp_path)
    assert done.returncode == 0, done.stderr[-2000:]


def test_queries_run_from_any_folder(tmp_path):
    done = run(ELSEWHERE.format(root=ROOT, folder=tmp_path), tmp_path)
    assert done.returncode == 0, done.stderr[-3000:]
