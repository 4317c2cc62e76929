"""Oracle SQL in the findings schema."""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S'"


def fsql(
    source: str,
    check_id: str,
    name: str,
    *,
    where: str = "TRUE",
    severity: str = "1",
    scope: str = "NULL",
    current: str = "NULL",
    target: str = "NULL",
    achieved: str = "FALSE",
    details: str = "NULL",
    at: str = "NULL",
    ctes: str = "",
) -> str:
    """SELECT in the findings schema; ``name`` is a literal unless it starts with '='."""
    label = name[1:] if name.startswith("=") else f"'{name}'"
    return (
        f"{ctes} SELECT server_id, '{check_id}' AS check_id, CAST({scope} AS VARCHAR) AS scope, CAST({severity} AS INT) AS severity, "
        f"{label} AS name, CAST({current} AS VARCHAR) AS current_value, CAST({target} AS VARCHAR) AS target_value, "
        f"{achieved} AS achieved, CAST({details} AS VARCHAR) AS details, CAST({at} AS TIMESTAMP) AS observed_at "
        f"FROM {source} WHERE {where}"
    )


def stamp(expr: str) -> str:
    return f"COALESCE(strftime({expr}, {TS}), 'N/A')"
