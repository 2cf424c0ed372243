"""Tables between steps: where they lie, and that they go with the session."""

import subprocess
import sys
import textwrap

import pytest

from tests.conftest import ROOT


def run(tmp_path, code, **more):
    """A session of its own with an empty configuration folder."""
    import os

    (tmp_path / "conf").mkdir(exist_ok=True)
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "TMPDIR": str(tmp_path), "PYTHONPATH": ROOT} | more
    env.pop("PYSPARK_GATEWAY_PORT", None)
    head = """
        from pyspark.sql import SparkSession
        builder = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
        from kinestream import shared
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(head) + textwrap.dedent(code)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout.strip().splitlines()[-1]


def test_a_session_without_a_setting(tmp_path):
    """Nothing names a folder: one for the application is made, used by all, and gone after it; queries run."""
    out = run(
        tmp_path,
        """
        import os
        spark = builder.getOrCreate()
        assert spark.conf.get("spark.checkpoint.dir", None) is None
        a = shared.written(spark.range(5), "a")
        assert shared.shared_dir(spark) == shared.shared_dir(spark.newSession())
        import __spark_entry__
        n = __spark_entry__.queries()["asof_age_distribution"](spark, "/root/testdata/sf0.001").count()
        found = shared.shared_dir(spark)
        assert a.count() == 5 and n > 0 and os.path.isdir(found)
        print(found)
        """,
    )
    import os

    assert out.startswith(str(tmp_path)) and not os.path.exists(out)


def test_tables_go_with_their_session(tmp_path):
    """In a folder that is named, stopping the session deletes its own tables and no others."""
    (tmp_path / "shared").mkdir()
    (tmp_path / "shared/tables-other").mkdir()
    run(
        tmp_path,
        f"""
        import os
        spark = builder.config("spark.checkpoint.dir", "{tmp_path}/shared").getOrCreate()
        shared.written(spark.range(5), "a")
        assert os.path.isdir(shared.tables_dir(spark))
        spark.stop()
        print("done")
        """,
    )
    assert [p.name for p in (tmp_path / "shared").iterdir() if p.name.startswith("tables-")] == ["tables-other"]


def test_a_cluster_must_name_a_folder():
    from kinestream import shared

    class Context:
        master, applicationId = "spark://host:7077", "x"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_dir(Session())
