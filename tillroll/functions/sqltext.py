"""Text helpers for the DuckDB oracle SQL, mirroring tillroll.functions.common."""

from __future__ import annotations

import datetime as dt
import re

from tillroll.sources.bind import AS_OF, BIND_DEPS, BIND_ORDER, BIND_SQL


def R(x: str, n: int = 2) -> str:
    s = f"1e{n}"
    return (f"(CASE WHEN ({x}) < 0 THEN -(CAST(FLOOR(-({x}) * {s} + 0.5e0) AS DOUBLE) / {s}) "
            f"ELSE CAST(FLOOR(({x}) * {s} + 0.5e0) AS DOUBLE) / {s} END)")


def MONEY(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE)"


def MEAN(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def RATIO(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0e0))"


def PCT(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) * 100e0 / NULLIF(CAST({den} AS DOUBLE), 0e0))"


def DAYS(later: str, earlier: str) -> str:
    return f"CAST(extract(day FROM ({later}) - ({earlier})) AS BIGINT)"


def MONTH(ts: str) -> str:
    return f"CAST(date_trunc('month', {ts}) AS DATE)"


def WEEK(ts: str) -> str:
    return f"CAST(date_trunc('week', {ts}) AS DATE)"


def TS_AGO(days: int = 0, as_of: dt.date = AS_OF) -> str:
    return f"TIMESTAMP '{(as_of - dt.timedelta(days=days)).isoformat()} 00:00:00'"


KEPT = "order_status <> 'Cancelled'"


def BUYERS(where: str = KEPT) -> str:
    """CTE ``buyers``: one row per customer with an order that meets ``where``."""
    return f"""buyers AS (
  SELECT customer_id, COUNT(order_id) AS bought, SUM(total_amount) AS spent, COUNT(total_amount) AS priced,
         MAX(order_date) AS latest
  FROM b_orders WHERE {where} GROUP BY customer_id)"""


#: CTE ``tagged``: one row per campaign with kept orders tagged with it.
TAGGED = f"""tagged AS (
  SELECT campaign_id, COUNT(order_id) AS sales, SUM(total_amount) AS takings, COUNT(total_amount) AS priced
  FROM b_orders WHERE {KEPT} GROUP BY campaign_id)"""


def oracle(body: str, ctes: str = "") -> str:
    """Prefix ``body`` with the binding CTEs it (or ``ctes``) mentions."""
    text = ctes + "\n" + body
    need: list[str] = []

    def want(name: str) -> None:
        for dep in BIND_DEPS.get(name, ()):
            want(dep)
        if name not in need:
            need.append(name)

    for name in BIND_ORDER:
        if re.search(rf"\b{name}\b", text):
            want(name)
    parts = [f"{n} AS (\n  {BIND_SQL[n]}\n)" for n in BIND_ORDER if n in need]
    if ctes.strip():
        parts.append(ctes.strip())
    body = body.strip()
    if body[:5].upper() == "WITH ":      # the body's own CTEs follow the bindings
        recursive = body[5:15].upper() == "RECURSIVE "
        parts.append(body[15 if recursive else 5:])
        return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts)
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
