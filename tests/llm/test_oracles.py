"""Every SQL-expressible query of the subpackage against DuckDB, and the rest by their contracts."""

import pytest

import __spark_entry__ as E
from screenrank.llm.catalogue import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracles import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    got, want = QUERIES[name](spark, SF_SMALL).toPandas(), duck(SF_SMALL).sql(ORACLES[name]).df()
    res = compare(name, got, want)
    assert res["cols_equal"] and res["hash_equal"], res
    assert len(got)


def test_entry_has_one_query_per_operator():
    names = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


def test_entry_works_without_the_subpackage(tmp_path):
    """A copy of the repository without llm and the pipeline still imports."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(root, "screenrank"), tmp_path / "screenrank",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(sum(q.startswith('op') for q in e.queries()), len(e.queries()) > 20)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.stdout.split() == ["0", "True"], out.stderr
