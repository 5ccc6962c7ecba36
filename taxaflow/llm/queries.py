"""All queries of this subpackage, and the SQL of those that SQL expresses."""

from taxaflow.llm import (
    queries_decontaminate,
    queries_dialogue,
    queries_katz,
    queries_lengths,
    queries_lines,
    queries_packing,
    queries_quality,
    queries_recipes,
    queries_sharding,
    queries_simhash,
    queries_warc,
    queries_wrapper,
)

_MODULES = (
    queries_simhash, queries_packing, queries_wrapper, queries_warc, queries_lengths, queries_decontaminate, queries_quality, queries_katz,
    queries_recipes, queries_sharding, queries_lines, queries_dialogue,
)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _MODULES for name, sql in module.ORACLE_SQL.items()}
