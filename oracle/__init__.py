"""DuckDB SQL twins of the registered Spark queries (the correctness oracle)."""
from __future__ import annotations


def registered_sql() -> dict[str, str]:
    from . import business, curation, dashboard, insights, maintenance, streaming
    out: dict[str, str] = {}
    out.update(business.sql())
    out.update(insights.sql())
    out.update(dashboard.sql())
    out.update(curation.sql())
    out.update(streaming.sql())
    out.update(maintenance.sql())
    return dict(sorted(out.items()))
