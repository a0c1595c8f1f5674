import __spark_entry__ as entry


def test_names_and_sql():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and all(isinstance(x, str) for x in sql.values())
    assert "pipeline" in queries and all(any(q.startswith(f"op{n}_") for q in queries) for n in range(1, 14))
    assert [x for x in sql if x.startswith("op")] == ["op5_line_quality_rules", "op9_benchmark_containment", "op12_conversation_trie", "op13_lookup_table_clusters"]
