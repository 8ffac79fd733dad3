"""SQL building blocks of the oracle queries: one CTE per intermediate table."""

from __future__ import annotations

AS_OF = "2001-08-01"
PAST = "1999-06-15"
YEAR = 2001
BRAND = "Brand#1"
STATE = "ASIA"


def rounded(value: str, scale: int = 2) -> str:
    """Half-up rounding of the shortest decimal text of a double."""
    return f"CAST(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,{scale})) AS DOUBLE)"


def total(column: str) -> str:
    return f"coalesce(CAST(sum({column}) AS DOUBLE), 0.0)"


def ratio(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0))"


def months_between(a: str, b: str) -> str:
    """Months from b to a (a >= b): whole months, plus days / 31 unless both end their month."""
    return (
        f"round((year({a})-year({b}))*12 + (month({a})-month({b})) + CASE WHEN day({a})=day({b}) "
        f"OR ({a}=last_day({a}) AND {b}=last_day({b})) THEN 0 ELSE (day({a})-day({b}))/31.0 END, 8)"
    )


def _postal(key: str) -> str:
    return f"lpad(CAST(10000000 + {key}*100003 AS VARCHAR), 8, '0')"


def _fixed_window(n: int, end: str, calendar: bool) -> str:
    inside = f"sale_date >= CAST({end} - INTERVAL {n} MONTH AS DATE)"
    volume = f"CASE WHEN {inside} THEN volume_hl END"
    b2b = f"CASE WHEN {inside} AND is_b2b THEN volume_hl END"
    if calendar:
        avg = f"{total(volume)} / {n}.0"
        b2b_sum = f"coalesce(sum({b2b}), CASE WHEN sum({volume}) IS NOT NULL THEN 0 END)"
    else:
        avg = ratio(f"sum({volume})", f"count({volume})")
        b2b_sum = f"sum({b2b})"
    return f"{avg} AS avg_volume_{n}m, {ratio(b2b_sum, f'sum({volume})')} * 100 AS b2b_share_{n}m"


def _relative_window(n: int, table_months: str = "months_from_last") -> str:
    def inside(c):
        return f"sum(CASE WHEN {table_months} <= {n} THEN {c} END)"

    share = rounded(f"{ratio(inside('b2b_revenue'), inside('revenue'))} * 100")
    return (
        f"coalesce({ratio(inside('volume_hl'), f'count(CASE WHEN {table_months} <= {n} THEN volume_hl END)')}, 0.0)"
        f" AS avg_volume_{n}m, CASE WHEN {inside('revenue')} > 0 THEN {share} ELSE 0.0 END AS b2b_share_{n}m"
    )


def _allocation(pct: str, target: str, shown: str, years: str = f"t.target_year = {YEAR}") -> str:
    return f"""
      SELECT client_id, brand, target_year, client_volume, brand_volume, {shown} AS share_pct, target_volume,
             {target} AS client_target
      FROM (SELECT v.client_id, v.brand, t.target_year, v.client_volume, b.brand_volume, t.target_volume,
                   {pct} AS pct
            FROM client_brand v JOIN brand_total b ON v.brand = b.brand
            JOIN targets t ON t.brand = v.brand AND {years})"""


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "sales": (
        (),
        f"""
      SELECT o.o_custkey AS client_id, l.l_partkey AS material_id,
             CASE WHEN (l.l_orderkey*7 + l.l_partkey) % 997 = 0 THEN NULL
                  ELSE o.o_orderpriority IN ('1-URGENT','2-HIGH') END AS is_b2b,
             CAST(l.l_quantity AS DECIMAL(12,2)) AS volume_hl,
             CAST(CAST(l.l_extendedprice AS DECIMAL(12,2))
                  * (CAST(1 AS DECIMAL(4,2)) - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS revenue,
             CAST(o.o_orderdate AS DATE) AS sale_date, p.p_size AS packaging_code,
             CASE WHEN (l.l_orderkey + l.l_partkey) % 101 = 0 THEN NULL ELSE p.p_brand END AS brand,
             p.p_name AS material, {_postal('c.c_nationkey')} AS postal_code
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN part p ON l.l_partkey = p.p_partkey JOIN customer c ON o.o_custkey = c.c_custkey""",
    ),
    "targets": (
        (),
        """
      SELECT CASE WHEN b.n <= 10 THEN b.p_brand ELSE 'Unsold ' || b.p_brand END AS brand, y.y AS target_year,
             CAST(b.n*1000 + (y.y-2000)*500 AS BIGINT) AS target_volume
      FROM (SELECT DISTINCT p_brand, CAST(substr(p_brand, 7) AS INT) AS n FROM part) b
      CROSS JOIN (SELECT 2000 AS y UNION ALL SELECT 2001 AS y) y""",
    ),
    "geo": (
        (),
        f"""
      SELECT CASE WHEN n.n_nationkey = 24 THEN '99999999' ELSE {_postal('n.n_nationkey')} END AS postal_code,
             n.n_name AS city, r.r_name AS state
      FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    ),
    "states": (
        (),
        """
      SELECT CASE WHEN r_name = 'AFRICA' THEN 'ATLANTIS' ELSE r_name END AS state, 'Region ' || r_name AS state_name,
             CAST(r_regionkey*10 AS DOUBLE) AS lat, CAST(r_regionkey*-10 AS DOUBLE) AS lon FROM region""",
    ),
    "filled": (
        ("sales",),
        """
      SELECT client_id, material_id, coalesce(is_b2b, FALSE) AS is_b2b, volume_hl, revenue, sale_date,
             coalesce(packaging_code, 0) AS packaging_code, coalesce(brand, 'Não informado') AS brand,
             coalesce(material, 'Não informado') AS material, coalesce(postal_code, 'Não informado') AS postal_code
      FROM sales""",
    ),
    "grain": (
        ("sales",),
        f"""
      SELECT client_id, strftime(sale_date, '%Y-%m') AS year_month, last_purchase,
             {months_between('last_purchase', 'sale_date')} AS months_from_last,
             sum(volume_hl) AS volume_hl, sum(revenue) AS revenue,
             sum(CASE WHEN is_b2b THEN revenue ELSE 0 END) AS b2b_revenue,
             sum(CASE WHEN is_b2b THEN volume_hl ELSE 0 END) AS b2b_volume
      FROM (SELECT *, max(sale_date) OVER (PARTITION BY client_id) AS last_purchase FROM sales)
      GROUP BY 1, 2, 3, 4""",
    ),
    "view": (
        ("grain",),
        f"""
      SELECT client_id, last_purchase, {_relative_window(3)}, {_relative_window(6)}
      FROM grain GROUP BY client_id, last_purchase""",
    ),
    "view_abs": (
        ("sales",),
        f"""
      SELECT client_id, max(sale_date) AS last_purchase, {_fixed_window(3, 'ref', False)}, {_fixed_window(6, 'ref', False)}
      FROM sales, (SELECT max(sale_date) AS ref FROM sales) GROUP BY client_id""",
    ),
    "view_cal": (
        ("sales",),
        f"""
      SELECT client_id, max(sale_date) AS last_purchase, {_fixed_window(3, 'ref', True)}, {_fixed_window(6, 'ref', True)}
      FROM sales, (SELECT max(sale_date) AS ref FROM sales) GROUP BY client_id""",
    ),
    "view_as_of": (
        ("sales",),
        f"""
      SELECT client_id, max(sale_date) AS last_purchase, {_fixed_window(3, f"DATE '{PAST}'", True)},
             {_fixed_window(6, f"DATE '{PAST}'", True)}
      FROM sales WHERE sale_date <= DATE '{PAST}' GROUP BY client_id""",
    ),
    "client_brand": (
        ("sales",),
        "SELECT client_id, brand, sum(volume_hl) AS client_volume FROM sales WHERE brand IS NOT NULL GROUP BY 1, 2",
    ),
    "brand_total": (
        ("sales",),
        "SELECT brand, sum(volume_hl) AS brand_volume FROM sales WHERE brand IS NOT NULL GROUP BY 1",
    ),
    "ct": (
        ("client_brand", "brand_total", "targets"),
        _allocation(
            f"{ratio('client_volume', 'brand_volume')} * 100", rounded("pct / 100 * target_volume"), rounded("pct")
        ),
    ),
    "ct_all": (
        ("client_brand", "brand_total", "targets"),
        _allocation(
            f"{ratio('client_volume', 'brand_volume')} * 100", rounded("pct / 100 * target_volume"), rounded("pct"), "TRUE"
        ),
    ),
    "ct4": (
        ("client_brand", "brand_total", "targets"),
        _allocation(
            rounded(f"{ratio('client_volume', 'brand_volume')} * 100", 4),
            rounded("target_volume * pct / 100"),
            "pct",
        ),
    ),
    "dim": (
        ("sales",),
        """
      SELECT row_number() OVER (ORDER BY client_id) AS client_key, client_id, postal_code
      FROM (SELECT client_id, postal_code, row_number() OVER (PARTITION BY client_id
                   ORDER BY sale_date DESC, postal_code) AS rn FROM sales) WHERE rn = 1""",
    ),
    "prod": (
        ("sales",),
        """
      SELECT row_number() OVER (ORDER BY brand NULLS FIRST) AS product_key, brand
      FROM (SELECT DISTINCT brand FROM sales)""",
    ),
    "prod_nn": (
        ("sales",),
        """
      SELECT row_number() OVER (ORDER BY brand) AS product_key, brand
      FROM (SELECT DISTINCT brand FROM sales WHERE brand IS NOT NULL)""",
    ),
    "times": (
        ("sales",),
        """
      SELECT row_number() OVER (ORDER BY sale_date) AS time_key, sale_date, CAST(year(sale_date) AS INT) AS year,
             CAST(month(sale_date) AS INT) AS month, strftime(sale_date, '%Y-%m') AS year_month,
             CAST(quarter(sale_date) AS INT) AS quarter
      FROM (SELECT DISTINCT sale_date FROM sales)""",
    ),
    "dim_geo": (
        ("dim", "geo"),
        "SELECT d.client_key, d.client_id, d.postal_code, g.city, g.state FROM dim d LEFT JOIN geo g USING (postal_code)",
    ),
    "dim_marked": (
        ("dim_geo",),
        """
      SELECT client_key, client_id, postal_code, coalesce(city, 'Não encontrado') AS city,
             coalesce(state, 'Não encontrado') AS state FROM dim_geo""",
    ),
    "gs": (
        ("sales", "dim_geo"),
        """
      SELECT s.client_id, s.brand, s.volume_hl, s.revenue, d.city, d.state
      FROM sales s LEFT JOIN dim_geo d USING (client_id)""",
    ),
    "by_state": (
        ("gs",),
        f"""
      SELECT state, {total('volume_hl')} AS volume, {total('revenue')} AS revenue,
             count(DISTINCT client_id) AS clients FROM gs WHERE state IS NOT NULL GROUP BY state""",
    ),
    "scorecard": (
        ("sales",),
        f"""
      SELECT brand, {total('volume_hl')} AS volume, {total('revenue')} AS revenue,
             count(DISTINCT client_id) AS clients, {ratio('sum(revenue)', 'sum(volume_hl)')} AS avg_price
      FROM sales WHERE brand IS NOT NULL GROUP BY brand""",
    ),
}


def with_ctes(body: str, *names: str) -> str:
    """``body`` preceded by the named tables and all they are made of."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = ",\n  ".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    return f"WITH {parts}\n{body}"
