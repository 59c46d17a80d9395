"""Tasks must run where the package is not installed."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_pages_parse_without_the_package_on_the_workers(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        from dockline.operators.pages import parse_pages
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
        pages = spark.createDataFrame([("u", "<title>t</title><p>x_y</p>")], "url string, html string")
        print("RESULT", parse_pages(pages).first().metadata.title)
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "RESULT t" in done.stdout, done.stderr[-2000:]


def test_folders_that_machines_do_not_share():
    from dockline.session import _shared

    assert _shared("local[4]", "file:/tmp/warehouse") and _shared("yarn", "hdfs://name/warehouse")
    assert not _shared("spark://host:7077", "file:/tmp/warehouse") and not _shared("local-cluster[2,1,1024]", "/tmp/warehouse")
