"""Common table expressions shared by the SQL of the catalog."""

from __future__ import annotations

# name -> (names it reads, body)
_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "lines": ((), """
        SELECT l.l_suppkey AS suppkey, n.n_name AS economy, r.r_name AS region, p.p_type AS category, p.p_brand AS brand,
               strftime(l.l_shipdate, '%Y-%m') AS period, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount,
               CAST(l.l_quantity AS DECIMAL(18,2)) AS units, l.l_returnflag AS flag
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey JOIN part p ON l.l_partkey = p.p_partkey"""),
    "obs": (("lines",), """
        SELECT economy, category, period, CAST(sum(amount) AS DOUBLE) AS value, CAST(sum(units) AS DOUBLE) AS quantity,
               CAST(sum(amount) AS DOUBLE) / CAST(sum(units) AS DOUBLE) AS unit_price
        FROM lines GROUP BY economy, category, period"""),
    "robs": (("lines",), """
        SELECT region AS economy, category, period, CAST(sum(amount) AS DOUBLE) AS value, CAST(sum(units) AS DOUBLE) AS quantity,
               CAST(sum(amount) AS DOUBLE) / CAST(sum(units) AS DOUBLE) AS unit_price
        FROM lines GROUP BY region, category, period"""),
    "fobs": (("lines",), """
        SELECT region AS economy, category, period, CAST(sum(amount) AS DOUBLE) AS value, CAST(sum(units) AS DOUBLE) AS quantity,
               CAST(sum(amount) AS DOUBLE) / CAST(sum(units) AS DOUBLE) AS unit_price
        FROM lines WHERE flag <> 'R' GROUP BY region, category, period"""),
    "headline": (("lines",), """
        SELECT economy, period, CAST(sum(amount) AS DOUBLE) / CAST(sum(units) AS DOUBLE) AS unit_price
        FROM lines GROUP BY economy, period"""),
    "rheadline": (("lines",), """
        SELECT region AS economy, period, CAST(sum(amount) AS DOUBLE) / CAST(sum(units) AS DOUBLE) AS unit_price
        FROM lines GROUP BY region, period"""),
    "fheadline": (("lines",), """
        SELECT region AS economy, period, CAST(sum(amount) AS DOUBLE) / CAST(sum(units) AS DOUBLE) AS unit_price
        FROM lines WHERE flag <> 'R' GROUP BY region, period"""),
    "weights": (("lines",), """
        SELECT economy, category, CAST(sum(amount) AS DOUBLE) / (SELECT CAST(sum(amount) AS DOUBLE) FROM lines) AS weight
        FROM lines GROUP BY economy, category"""),
    "rweights": (("lines",), """
        SELECT region AS economy, category,
               CAST(sum(amount) AS DOUBLE) / (SELECT CAST(sum(amount) AS DOUBLE) FROM lines) AS weight
        FROM lines GROUP BY region, category"""),
    "rel": (("obs",), """
        SELECT o.economy, o.category, o.period, 100.0 * o.unit_price / b.unit_price AS price_relative
        FROM obs o JOIN obs b ON o.economy = b.economy AND o.category = b.category AND b.period = '1996-01'"""),
    "rrel": (("robs",), """
        SELECT o.economy, o.category, o.period, 100.0 * o.unit_price / b.unit_price AS price_relative
        FROM robs o JOIN robs b ON o.economy = b.economy AND o.category = b.category AND b.period = '1996-01'"""),
    "segments": ((), """
        SELECT c_nationkey, c_mktsegment, count(*) AS n, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS balance
        FROM customer GROUP BY c_nationkey, c_mktsegment"""),
    "profiles": (("segments",), """
        SELECT n.n_name AS economy, r.r_name AS region,
               CASE WHEN t.mean_balance >= 4500 THEN 'HIGH' ELSE 'LOW' END AS income_group,
               t.traits AS characteristics, t.mean_balance, o.mean_order
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
        JOIN (SELECT s.c_nationkey, CAST(any_value(x.b) AS DOUBLE) / any_value(x.customers) AS mean_balance,
                     coalesce(list(s.c_mktsegment ORDER BY s.c_mktsegment) FILTER (WHERE s.n * 5 > x.customers), []) AS traits
              FROM segments s JOIN (SELECT c_nationkey, sum(n) AS customers, sum(balance) AS b FROM segments GROUP BY 1) x
                ON s.c_nationkey = x.c_nationkey GROUP BY s.c_nationkey) t ON t.c_nationkey = n.n_nationkey
        LEFT JOIN (SELECT c_nationkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_order
              FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey) o ON o.c_nationkey = n.n_nationkey"""),
    "calendar": (("robs",), """
        SELECT period, CAST(last_day(CAST(period || '-01' AS DATE)) + CAST(15 + (year(CAST(period || '-01' AS DATE)) * 12
               + month(CAST(period || '-01' AS DATE))) % 10 AS INTEGER) AS DATE) AS release_date
        FROM (SELECT DISTINCT period FROM robs)"""),
}


def add(name: str, body: str, *reads: str) -> None:
    """Add a named expression built on earlier ones."""
    if name in _PARTS:
        raise ValueError(f"expression defined twice: {name}")
    _PARTS[name] = (reads, body)


def sql(body: str, *names: str, recursive: bool = False, extra: dict[str, str] | None = None) -> str:
    """Put the needed expressions, in reading order, before ``body``."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in _PARTS[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    parts = [f"{name} AS ({_PARTS[name][1]})" for name in order]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    head = ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" if parts else ""
    return head + body


def rnd(expression: str, places: int = 6) -> str:
    """Rounded value without a negative zero."""
    return f"(round({expression}, {places}) + 0.0)"
