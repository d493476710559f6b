"""The engine's own queries, one module per family of operators, and their DuckDB oracles."""

from caseledger.queries import aggregates, forms, harvest, kpi, ledger, ordered, records, register, registers, rules, scalars, scenario, text  # noqa: F401  (they register themselves)
from caseledger.queries.base import ORACLE_SQL, QUERIES  # noqa: F401
