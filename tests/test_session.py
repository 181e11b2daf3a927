"""The session leaves a submitted job's placement alone."""

import os
import pathlib
import subprocess
import sys
import types

import pyspark
import pytest

from lodgeframe import session

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_submitted_master_and_partitions_stay(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {str(ROOT)!r})\n"
        "from lodgeframe.session import get_session\n"
        "s = get_session()\n"
        "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))\n")
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_GATEWAY_PORT"}
    out = subprocess.run(
        [submit, "--master", "local[2]", "--conf", "spark.sql.shuffle.partitions=400",
         "--conf", "spark.ui.enabled=false", str(script)], cwd=tmp_path, timeout=120,
        env=env | {"PYSPARK_PYTHON": sys.executable}, capture_output=True, text=True)
    assert "GOT local[2] 400" in out.stdout, out.stderr[-2000:]


def _session(master, folder=None, context_folder=None):
    conf = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "file:/wh"}
    seen = [context_folder]
    sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: seen[0],
                               setCheckpointDir=lambda d: seen.__setitem__(0, d))
    return types.SimpleNamespace(
        sparkContext=sc, conf=types.SimpleNamespace(get=lambda k, d=None: conf.get(k) or d))


def test_a_cluster_must_name_a_checkpoint_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_session("yarn"))
    assert session.ensure_checkpoint_dir(_session("yarn", "hdfs:/c")) == "hdfs:/c"
    assert session.ensure_checkpoint_dir(_session("local[2]")) == "file:/wh/_checkpoints"


def test_no_machine_local_temporary_folder():
    for f in (ROOT / "lodgeframe").rglob("*.py"):
        assert "tempfile" not in f.read_text(), f
