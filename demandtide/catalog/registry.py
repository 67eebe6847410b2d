"""Registry of queries and the SQL fragments they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def idx(date: str) -> str:
    return f"CAST(year({date}) * 12 + month({date}) AS INTEGER)"


def ym(m: str) -> str:
    return f"CAST((({m}) - 1) // 12 * 100 + (({m}) - 1) % 12 + 1 AS INTEGER)"


def date_of(m: str) -> str:
    return f"CAST(make_date(CAST((({m}) - 1) // 12 AS BIGINT), CAST((({m}) - 1) % 12 + 1 AS BIGINT), 1) AS DATE)"


def r4(x: str) -> str:
    return f"(floor(({x}) * 1e4 + 0.5) / 1e4)"


def div(a: str, b: str) -> str:
    return f"(({a}) / NULLIF(({b}), 0))"


# Shared relations, in dependency order; the Spark twins live in roles.py.
_RELATIONS = {
    "lines": f"""SELECT l_partkey AS sku, CASE WHEN l_linestatus = 'O' THEN 'di' ELSE 'eib' END AS label,
        {idx('l_shipdate')} AS m, l_quantity AS qty,
        CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE ELSE l_quantity END AS kept, l_extendedprice AS amount,
        l_orderkey, l_suppkey FROM lineitem""",
    "master": """SELECT p_partkey AS sku, split_part(p_name, ' ', 2) AS country, p_brand AS brand, p_type AS tier,
        'S' || CAST((p_size - 1) // 10 + 1 AS VARCHAR) AS stage, p_size, p_name, p_retailprice FROM part""",
    "sku_label": "SELECT sku, label, m, sum(qty) AS offtake, sum(kept) AS sellin FROM lines GROUP BY ALL",
    "panel0": """SELECT sku, m,
        coalesce(sum(offtake) FILTER (label = 'di'), 0) AS offtake_di,
        coalesce(sum(offtake) FILTER (label = 'eib'), 0) AS offtake_eib, sum(offtake) AS offtake_il,
        coalesce(sum(sellin) FILTER (label = 'di'), 0) AS sellin_di,
        coalesce(sum(sellin) FILTER (label = 'eib'), 0) AS sellin_eib, sum(sellin) AS sellin_il
        FROM sku_label GROUP BY ALL""",
    "panel": "SELECT p.*, country, brand, tier, stage FROM panel0 p JOIN master USING (sku)",
    "months": "SELECT DISTINCT m FROM lines",
    "ranked": "SELECT m, CAST(row_number() OVER (ORDER BY m) AS INTEGER) AS r FROM months",
    "channel_lines": """SELECT sku, label, m, qty, kept, o_orderpriority AS channel, o_orderstatus AS status,
        CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS om, o_custkey
        FROM lines JOIN orders ON l_orderkey = o_orderkey""",
    "lags": "SELECT CAST(unnest(range(1, 12)) AS INTEGER) AS lag",
    "based": """SELECT sku, label, m, sum(actual) AS actual, sum(base) AS base FROM (
        SELECT sku, label, m, offtake AS actual, 0.0::DOUBLE AS base, 0 AS b FROM sku_label
        UNION ALL SELECT sku, label, m + 12, 0.0::DOUBLE, offtake, 1 FROM sku_label)
        WHERE m <= (SELECT max(m) FROM lines) GROUP BY sku, label, m HAVING sum(b) > 0""",
    "cycles": """SELECT sku, label, m, lag, m - lag AS cycle, actual, base * (1 + lag / 64.0::DOUBLE) AS forecast
        FROM based, lags""",
    "leafs": "SELECT c.*, country, brand, tier, stage FROM cycles c JOIN master USING (sku)",
}


def with_sql(body: str, *names: str) -> str:
    """The body under the shared relations it names and those they build on."""
    needed: set[str] = set()

    def add(name: str) -> None:
        needed.add(name)
        for other, text in _RELATIONS.items():
            if other not in needed and other in _words(_RELATIONS[name]):
                add(other)

    for name in names:
        add(name)
    ctes = ", ".join(f"{name} AS ({text})" for name, text in _RELATIONS.items() if name in needed)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


def _words(text: str) -> set[str]:
    return set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
