"""Every query over the smallest tables: its SQL where there is one, and the columns of its contract."""

import os
from pathlib import Path

import duckdb
import pytest

from quern.llm.oracles import ORACLES
from quern.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(DATA), reason="driver tables are not here")

COLUMNS = {
    "op1": "doc_id held_out lang_pred score",
    "op2": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3": "doc_id held_out score predicted",
    "op4": "doc_id item_id",
    "op5": "doc_id n_shingles component_id kept",
    "op6": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op7": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op8": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9": "doc_id held_out score predicted",
    "op11": "vec_id n_links component_id kept",
    "op12": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op13": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op10": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, str(DATA))
    rows = [tuple(r) for r in df.collect()]
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(df.columns)
    if not name.startswith("op4"):
        whole = "embeddings" if name.startswith("op11") else "documents"
        assert len(rows) == spark.read.parquet(f"{DATA}/{whole}.parquet").count()
    if name not in ORACLES:
        return
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    order = sorted(names)
    assert order == sorted(df.columns)
    normal = lambda found, cols: sorted(tuple(repr(r[cols.index(c)]) for c in order) for r in found)
    assert normal(rows, df.columns) == normal(result.fetchall(), names)
