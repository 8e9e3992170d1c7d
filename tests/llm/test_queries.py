import os

import pytest

from tessera.llm.queries import QUERIES, SQL
from tests.oracle import connect, same

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no data")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        same(df, connect(FOLDER), SQL[name])
    else:
        assert df.count() >= 0


def test_nothing_else_imports_this_subpackage():
    import pathlib

    import tessera

    root = pathlib.Path(tessera.__file__).parent
    for p in root.rglob("*.py"):
        if root / "llm" not in p.parents:
            assert "tessera.llm" not in p.read_text()
