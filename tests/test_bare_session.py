"""The library must run on any session a user already has."""

import os
import subprocess
import sys


def test_entry_and_queries_on_a_plain_session(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-m", "tests.bare_session", str(tmp_path)], cwd=root, capture_output=True, text=True, timeout=600)
    assert "bare session: ok" in run.stdout, run.stderr[-3000:]


def test_queries_and_sql_are_read_before_there_is_a_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; from pyspark import SparkContext; print('read:', len(e.queries()) > 200, len(e.oracle_sql()) > 200, SparkContext._active_spark_context)"
    run = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert "read: True True None" in run.stdout, run.stderr[-3000:]
    assert "left out" not in run.stderr, run.stderr[-3000:]
