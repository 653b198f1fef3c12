"""Every registered query against its SQL on the smallest driver tables."""

from pathlib import Path

import duckdb
import pytest

from catalog.oracles import ORACLES
from catalog.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def normal(rows, names, order):
    at = [names.index(c) for c in order]
    return sorted(tuple(repr(row[i]) for i in at) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, str(DATA))
    rows = [tuple(r) for r in df.collect()]
    assert df.columns and len(set(df.columns)) == len(df.columns)
    if name not in ORACLES:
        assert rows
        return
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    assert normal(rows, df.columns, order) == normal(result.fetchall(), names, order)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


TELEMETRY = [
    "runtime_hours",
    "power_threshold",
    "smooth_power",
    "tail_mean",
    "low_runs",
    "tail_cutoff",
    "kept_samples",
    "run_energy",
    "run_duration",
    "energy_report_tokens",
]


@pytest.mark.parametrize("name", TELEMETRY)
def test_oversized_runs_give_the_same_rows(spark, con, name, monkeypatch):
    """A limit between the runs' sizes sends some to each plan; small blocks cross every run."""
    from quern.operators import energy, ordered

    monkeypatch.setattr(ordered, "GROUP_ROWS", 70)
    monkeypatch.setattr(ordered, "BLOCK_BITS", 4)
    monkeypatch.setattr(energy, "BLOCK_BITS", 4)
    test_query(spark, con, name)
