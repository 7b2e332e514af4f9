import json

import pytest


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:6] == ["ENTITYID", "Internal ID", "Original Internal ID", "ObligorName", "DateOfFinancials", "DateLastAudit"]
    assert len(df.columns) == 35


def test_every_query_has_oracle(spark):
    import __spark_entry__ as E

    own = {k for k in E.queries() if k != "pipeline" and not k.startswith("op")}
    assert own == {k for k in E.oracle_sql() if not k.startswith("op")}


def test_entry_without_the_optional_subpackage():
    """The other queries are there when the subpackage is not."""
    import subprocess
    import sys
    from pathlib import Path

    code = (
        "import sys; sys.modules['finwater.llm'] = None\n"
        "import __spark_entry__ as E\n"
        "assert E.llm_queries is None and set(E.queries()) == set(E.oracle_sql()) and len(E.queries()) > 30"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], check=True)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_oracle_agreement(spark, sf):
    import __spark_entry__ as E
    from tools.check_oracle import compare

    res = compare(spark, sf, [k for k in E.oracle_sql() if not k.startswith("op")])
    bad = {k: v for k, v in res.items() if v != "OK"}
    assert not bad, json.dumps(bad, indent=1)
