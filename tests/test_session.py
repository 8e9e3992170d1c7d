import os
import zipfile
from pathlib import Path

import pytest

from tessera import session


def test_persisted_and_cleared(spark):
    df = session.persisted(spark.range(5).selectExpr("id", "id % 2 AS part"), "x", ["part"])
    assert df.count() == 5 and session.persisted(spark.range(0), "empty").count() == 0
    paths = list(session._WRITTEN[spark.sparkContext.applicationId])
    assert all(os.path.isdir(p.removeprefix("file://")) for p in paths)
    assert session.clear(spark) == len(paths) and not any(os.path.exists(p.removeprefix("file://")) for p in paths)


def test_small_is_counted(spark):
    plan = lambda df: spark.range(9).join(session.small(df, 5), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(spark.range(5)) and "broadcast" not in plan(spark.range(6))


def test_package_is_shipped_where_workers_lack_it(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "_SHIPPED", set())
    monkeypatch.setenv("PYTHONPATH", "")
    monkeypatch.chdir(tmp_path)
    sent = []
    monkeypatch.setattr(type(spark.sparkContext), "addPyFile", lambda self, p: sent.append(p))
    session.ship(spark)
    session.ship(spark)
    assert len(sent) == 1 and "tessera/session.py" in zipfile.ZipFile(sent[0]).namelist()
    Path(sent[0]).unlink()


def test_a_cluster_must_name_its_folder(spark, monkeypatch):
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://x"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())
