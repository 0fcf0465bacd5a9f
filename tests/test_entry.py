"""The driver contract, with and without the removable training-data subpackage."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sorted(n for n in e.queries() if n[:2] == 'op'))"


def ask(folder):
    env = os.environ | {"PYTHONPATH": str(folder), "PYTHONDONTWRITEBYTECODE": "1"}
    return subprocess.run([sys.executable, "-c", ASK], cwd=folder, env=env, capture_output=True, text=True, timeout=120)


def test_entry_without_the_training_data_operators(tmp_path):
    from chatscope.plans.oracle import SQL
    from chatscope.plans.queries import QUERIES
    shutil.copytree(f"{REPO}/chatscope", tmp_path / "chatscope", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    done = ask(tmp_path)
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip() == f"{len(QUERIES)} {len(SQL)} []"


def test_nothing_else_names_the_subpackage():
    for top, _, files in os.walk(f"{REPO}/chatscope"):
        if "/llm" in top or "__pycache__" in top:
            continue
        for f in files:
            with open(os.path.join(top, f), encoding="utf-8") as text:
                assert "chatscope.llm" not in text.read(), f"{top}/{f}"


def test_workers_find_the_library_from_anywhere(tmp_path):
    code = (f"import sys; sys.path.insert(0, {REPO!r})\n"
            "from pyspark.sql import SparkSession\n"
            "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "import __spark_entry__ as e\n"
            "print('ROWS', e.queries()['json_key_paths'](spark, '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]
