"""Registered queries against their SQL on the smallest tables, and the shape of the registry."""

import math
from pathlib import Path

import duckdb
import pytest

from dialoom.plans import registry

SF = Path("/root/testdata/sf0.001")
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date"}
#: A cross-section by group, to keep the run short; every other query is compared in the same way at sf0.01 by the driver.
NAMES = ["q_session_structure", "q_opening_groups", "q_opening_directions", "q_retention", "q_entity_metrics", "q_rollup_metrics", "q_segment_overall", "q_segment_top10", "q_period_metrics", "q_candidate_baseline", "q_two_factor", "q_stratified_sample", "q_match_greedy", "q_routes", "q_candidates_multi_day", "q_audit_p18_dictionary",
         "q_context_fold", "q_context_chain", "q_signals_carried", "q_safe_turn_lists", "q_candidates_mined", "q_stable_pseudonym", "q_turn_export", "q_raw_export", "q_replaced_days", "q_backed_up_days", "q_unchanged_days", "q_period_words", "q_period_words_backfill"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    return f"{value + 0.0:.7g}" if isinstance(value, float) else str(value)


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, str(SF))
    columns = sorted(df.columns)
    rel = duck.sql(registry.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    kinds = dict(df.dtypes)
    assert {c: KINDS[str(t)] for c, t in zip(rel.columns, rel.types, strict=True)} == kinds
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    theirs = sorted(tuple(plain(v) for v in row) for row in duck.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({registry.oracle_sql()[name]})").fetchall())
    assert ours == theirs


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert registry.FLAGSHIP in registry.queries()
