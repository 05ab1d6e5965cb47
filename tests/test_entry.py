import pytest

import __spark_entry__ as entry_mod
from tools.oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["property_uuid", "final_score"]
    rows = df.collect()
    assert len(rows) > 0 and all(0 <= r.final_score <= 100 for r in rows)


def test_every_query_has_reference_sql():
    from merchpulse import queries

    assert set(queries.QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", ["final_scores", "all_quotas_hybrid", "growth_pairs", "quota_json",
                                  "date_reformat"])
def test_matches_duckdb(spark, name):
    ok, rows, _, _, detail = compare(spark, duck_connection(SF), name, entry_mod.queries()[name],
                                     entry_mod.oracle_sql()[name], SF)
    assert ok, detail
    assert rows > 0
