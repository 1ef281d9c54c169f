"""Query plans: registered queries and their oracles."""

from __future__ import annotations

from stratafold.plans import access, batch, checks, grids, parameters, records, repair, review, structure, summaries, text_layer  # noqa: F401  (they register their queries)
from stratafold.plans.document import PARSED, parsed_sql
from stratafold.plans.folded import FOLDED, folded_sql
from stratafold.plans.registry import duck_sql, spark_queries
from stratafold.plans.streamed import STREAMED, streamed_sql
from stratafold.plans.tree import TREES, tree_sql


def all_queries() -> dict:
    return spark_queries() | FOLDED | PARSED | STREAMED | TREES


def all_sql() -> dict[str, str]:
    return duck_sql() | folded_sql() | parsed_sql() | streamed_sql() | tree_sql()
