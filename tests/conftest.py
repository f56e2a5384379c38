import math
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(value):
    """A value as both engines give it: floats to nine digits, lists and structs as tuples, times as text."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(x) for x in value)
    if isinstance(value, dict):
        return tuple(_plain(x) for x in value.values())
    return str(value) if hasattr(value, "isoformat") else value


@pytest.fixture(scope="session")
def same_as_sql(spark):
    """Compares a query's rows, whatever their order, with those of its SQL in DuckDB over the same tables."""

    def compare(query, sql, folder):
        import duckdb

        base = duckdb.connect()
        for name in TABLES:
            if os.path.exists(f"{folder}/{name}.parquet"):
                base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        found = base.execute(sql)
        names = [c[0] for c in found.description]
        frame = query(spark, folder)
        assert sorted(frame.columns) == sorted(names)
        order = sorted(names)
        wanted = sorted((tuple(_plain(dict(zip(names, row))[c]) for c in order) for row in found.fetchall()), key=repr)
        got = sorted((tuple(_plain(row[c]) for c in order) for row in frame.select(*order).collect()), key=repr)
        assert len(got) == len(wanted)
        differing = [(a, b) for a, b in zip(got, wanted) if a != b]
        assert not differing, differing[:3]
        return len(got)

    return compare
