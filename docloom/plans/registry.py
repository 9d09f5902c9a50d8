"""All registered queries of the library's own operators, with their SQL."""

from __future__ import annotations

from docloom.plans import accounting, files, joins, scalars, scoring, stateful, streams  # noqa: F401  they register
from docloom.plans.base import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
