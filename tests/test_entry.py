import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry


def test_contract(spark):
    qs, sql = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 50
    assert set(sql) <= set(qs)
    df = entry.entry(spark)
    assert set(df.columns) == {"day", "n_active", "n_entities"}
    assert df.count() > 0


def test_queries_run_on_smoke_data(spark):
    qs = entry.queries()
    for name in ("w3_entity_status", "j7_active_count", "n5_network_distance", "a10_describe"):
        assert qs[name](spark, "/root/testdata/sf0.001").count() >= 0


def test_every_oracle_binds_in_duckdb():
    import duckdb

    from paneljet.plans.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for name, sql in entry.oracle_sql().items():
        con.execute(f"EXPLAIN {sql}")      # raises on syntax or binding errors


@pytest.mark.parametrize("blocked", ["public_tokenizers", "ahocorasick", "paneljet.llm", "numpy.no_such"])
def test_panel_queries_stay_when_training_data_cannot_be_imported(blocked):
    """A missing package takes the training-data queries with it, never the others."""
    code = (f"import sys; sys.modules[{blocked!r}] = None\nimport __spark_entry__ as e\n"
            "print(len([q for q in e.queries() if not q.startswith('op')]), len(e.oracle_sql()))")
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=home, capture_output=True, text=True, check=True)
    n, sql = map(int, out.stdout.split()[-2:])
    assert n >= 75 and sql >= 72
