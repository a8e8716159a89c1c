"""Every oracle is DuckDB SQL of a registered query."""

import __spark_entry__ as entry


def test_every_oracle_is_sql_text():
    oracles = entry.oracle_sql()
    assert set(oracles) <= set(entry.queries())
    assert [name for name, sql in oracles.items() if not isinstance(sql, str)] == []
