import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "cnt", "avg_temp", "window_end"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_nondeterministic():
    from tempest.plans.oracle import ORACLE
    from tempest.plans.registry import QUERIES

    assert set(E.oracle_sql()) <= set(E.queries())
    q, o = QUERIES, ORACLE
    assert set(o) <= set(q)
    assert set(q) - set(o) <= {"rich_map"} | {k for k in q if k.startswith("stream_")} - set(o)


def test_every_query_names_its_survey_ids():
    from tempest.plans.registry import SURVEY_IDS

    from tempest.plans.registry import QUERIES

    assert set(SURVEY_IDS) == set(QUERIES) <= set(E.queries())


def test_every_oracle_sql_runs_in_duckdb():
    import duckdb

    from .conftest import SF_SMALL

    con = duckdb.connect()
    for t in ("events", "documents", "embeddings", "labels", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        cols = [d[0] for d in con.execute(f"DESCRIBE {sql}").fetchall()]
        assert cols and len(cols) == len(set(cols)), name


def test_entry_works_without_the_llm_folders():
    """The rest of the library imports nothing of them, and the entry module only where they are."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(E.__file__))
    code = ("import sys; sys.modules['corpus_pipeline'] = None; sys.modules['tempest.llm'] = None\n"
            "import __spark_entry__ as e, pkgutil, tempest, importlib\n"
            "[importlib.import_module(m.name) for m in pkgutil.walk_packages(tempest.__path__, 'tempest.') if not m.name.startswith(('tempest.llm', 'tempest.__main__'))]\n"
            "q = e.queries(); assert 'word_count' in q and not any(k.startswith('op') for k in q) and set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
