"""Driver contract: entry runs, every oracle key has a query, names line up."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["request_id", "gpu_uuid", "metric_name", "value", "timestamp", "labels_raw"]


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


def test_the_rest_works_without_the_llm_folders(tmp_path):
    """On a copy without them (and without the pipeline, or with it alone) the other queries are all there."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for pipeline in (True, False):
        copy = tmp_path / f"copy{pipeline}"
        copy.mkdir()
        shutil.copytree(f"{root}/telemetry_engine", copy / "telemetry_engine", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        shutil.copy(f"{root}/__spark_entry__.py", copy)
        if pipeline and os.path.exists(f"{root}/corpus_pipeline.py"):
            shutil.copy(f"{root}/corpus_pipeline.py", copy)
        code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), 'pipeline' in q)"
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, check=True)
        n, with_pipeline = out.stdout.split()
        assert int(n) >= 61 and with_pipeline == "False"
