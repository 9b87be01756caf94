"""Every query with SQL against DuckDB, at the smallest scale."""

import __spark_entry__ as entry
import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def value(v):
    if hasattr(v, "item"):
        v = v.item()
    if v is None or v != v:
        return None
    return round(v, 6) if isinstance(v, float) else v


def rows(frame):
    columns = sorted(frame.columns)
    found = [tuple(value(v) for v in r) for r in frame[columns].itertuples(index=False)]
    return columns, sorted(found, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, db, name):
    found = entry.queries()[name](spark, SMALL).toPandas()
    assert rows(found) == rows(db.execute(SQL[name]).fetchdf())


def test_entry(spark):
    assert entry.entry(spark).columns == ["source1_entity_id", "candidate_entity_id"]


def test_imports_without_the_text_operators(tmp_path):
    import pathlib
    import shutil
    import subprocess
    import sys

    root = pathlib.Path(entry.__file__).parent
    shutil.copytree(root / "linkloom", tmp_path / "linkloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and not any(n.startswith('op') for n in q), q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})
