import importlib.util
import os


def _entry():
    p = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", p)
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_runs_and_contract(spark):
    m = _entry()
    df = m.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"doc_id_a", "doc_id_b", "n_common", "n_union", "jaccard"}
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_cli_run_writes_blocks(spark):
    from quarry import cli
    from quarry.session import scratch_path
    from quarry.sources import ratings_text
    out = scratch_path(spark, "cli")
    assert cli.main(["run", "fallback_scores", "--data", "/root/testdata/sf0.001", "--out", out,
                     "--format", "blocks", "--local", "2"]) == 0
    back = ratings_text.read_blocks(spark, out)
    assert back.count() == m_count(spark)


def m_count(spark):
    return _entry().queries()["fallback_scores"](spark, "/root/testdata/sf0.001").count()
