"""The queries that SQL can express, against their SQL on the smallest tables."""

import pytest

from compare_util import compare, duck
from wxmesh.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op12_prefix_trie", "op13_spelling_variants"])
def test_query_matches_its_sql(spark, name):
    query, sql = QUERIES[name]
    r = compare(query(spark, SF_DIR), duck(SF_DIR), sql)
    assert r["columns_match"] and r["rows"][0] == r["rows"][1] > 0
    assert r["hash_match"]
