"""The sales model of :mod:`tillroll.plans.driver`, written as DuckDB SQL.

These views are the independent statement of each query's expected result
that the correctness check runs next to the Spark plan. They use ``||`` for
NULL-propagating concatenation (DuckDB's ``concat`` skips NULLs) and
explicit ``NULLS LAST`` orderings.
"""

from __future__ import annotations

_VIEWS: dict[str, str] = {
    "sale_lines": """
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_returnflag,
         o.o_custkey, o.o_orderdate, o.o_orderpriority, s.s_nationkey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "sale": """
  SELECT CAST(o_custkey AS BIGINT) AS customer_id, CAST(s_nationkey AS BIGINT) AS store_id,
         CAST(NULL AS VARCHAR) AS product_name, CAST(o_orderdate AS DATE) AS sales_date,
         CAST(l_suppkey AS BIGINT) AS sales_person_id, CAST(NULL AS DECIMAL(10,2)) AS price,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS total_cost,
         CAST(NULL AS VARCHAR) AS additional_column
  FROM sale_lines""",
    "sale_extras": """
  SELECT CAST(sl.o_custkey AS BIGINT) AS customer_id, CAST(sl.s_nationkey AS BIGINT) AS store_id,
         p.p_name AS product_name, CAST(sl.o_orderdate AS DATE) AS sales_date,
         CAST(sl.l_suppkey AS BIGINT) AS sales_person_id, CAST(p.p_retailprice AS DECIMAL(10,2)) AS price,
         CAST(sl.l_quantity AS INTEGER) AS quantity, CAST(sl.l_extendedprice AS DECIMAL(10,2)) AS total_cost,
         sl.o_orderpriority AS payment_mode,
         CASE WHEN sl.l_returnflag <> 'N' THEN sl.l_returnflag END AS coupon,
         CASE WHEN sl.o_orderpriority = '4-NOT SPECIFIED' AND sl.l_returnflag = 'R' THEN '4-RETURNED'
              ELSE sl.o_orderpriority END AS desk
  FROM sale_lines sl JOIN part p ON sl.l_partkey = p.p_partkey""",
    "sale_product": """
  SELECT CAST(sl.o_custkey AS BIGINT) AS customer_id, CAST(sl.s_nationkey AS BIGINT) AS store_id,
         p.p_name AS product_name, CAST(sl.o_orderdate AS DATE) AS sales_date,
         CAST(sl.l_suppkey AS BIGINT) AS sales_person_id, CAST(p.p_retailprice AS DECIMAL(10,2)) AS price,
         CAST(sl.l_quantity AS INTEGER) AS quantity, CAST(sl.l_extendedprice AS DECIMAL(10,2)) AS total_cost,
         CAST(NULL AS VARCHAR) AS additional_column
  FROM sale_lines sl JOIN part p ON sl.l_partkey = p.p_partkey""",
    "customer_dim": """
  SELECT CAST(c_custkey AS BIGINT) AS customer_id,
         split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         c_mktsegment || ' district ' || CAST(c_nationkey AS VARCHAR) AS address,
         lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS pincode,
         lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone_number
  FROM customer""",
    "store_dim": """
  SELECT CAST(n.n_nationkey AS BIGINT) AS id, n.n_name AS address,
         lpad(CAST(n.n_regionkey AS VARCHAR), 6, '0') AS store_pincode, r.r_name AS store_manager_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "sales_team_dim": """
  SELECT CAST(s_suppkey AS BIGINT) AS id,
         split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
         CAST(s_nationkey AS BIGINT) AS manager_id, 'N' AS is_manager,
         'Zone ' || CAST(s_nationkey AS VARCHAR) AS address,
         lpad(CAST(s_nationkey AS VARCHAR), 6, '0') AS pincode
  FROM supplier""",
    "enriched": """
  SELECT f.customer_id, f.store_id, f.sales_person_id, f.sales_date, f.total_cost,
         c.first_name, c.last_name, c.address, c.pincode, c.phone_number,
         st.address AS store_address, st.store_manager_name,
         t.first_name AS sales_person_first_name, t.last_name AS sales_person_last_name,
         t.manager_id, t.is_manager, t.address AS sales_person_address, t.pincode AS sales_person_pincode
  FROM sale f
  JOIN customer_dim c ON f.customer_id = c.customer_id
  JOIN store_dim st ON f.store_id = st.id
  JOIN sales_team_dim t ON f.sales_person_id = t.id""",
    "customer_raw": """
  SELECT customer_id, first_name, last_name, address, pincode, phone_number, sales_date, total_cost
  FROM enriched""",
    "sales_team_raw": """
  SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name,
         store_manager_name, manager_id, is_manager, sales_person_address, sales_person_pincode,
         sales_date, total_cost, substring(CAST(sales_date AS VARCHAR), 1, 7) AS sales_month
  FROM enriched""",
    "customer_monthly": """
  SELECT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
         substring(CAST(sales_date AS VARCHAR), 1, 7) AS sales_date_month,
         CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM customer_raw
  GROUP BY ALL""",
    "seller_totals": """
  SELECT store_id, sales_person_id, sales_person_first_name || ' ' || sales_person_last_name AS full_name,
         sales_month, CAST(sum(total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM sales_team_raw
  GROUP BY ALL""",
    "seller_ranked": """
  SELECT *, rank() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC NULLS LAST) AS rnk
  FROM seller_totals""",
    "sales_team_monthly": """
  SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
         CAST(CASE WHEN rnk = 1 THEN round(total_sales * 0.01, 2) ELSE 0 END AS DECIMAL(18,2)) AS incentive
  FROM seller_ranked""",
}

# Dependencies between views, so a query only carries what it uses.
_DEPS: dict[str, list[str]] = {
    "sale": ["sale_lines"],
    "sale_extras": ["sale_lines"],
    "sale_product": ["sale_lines"],
    "enriched": ["sale", "customer_dim", "store_dim", "sales_team_dim"],
    "customer_raw": ["enriched"],
    "sales_team_raw": ["enriched"],
    "customer_monthly": ["customer_raw"],
    "seller_totals": ["sales_team_raw"],
    "seller_ranked": ["seller_totals"],
    "sales_team_monthly": ["seller_ranked"],
}


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


# Sales of the accepted landing drops (see tillroll.plans.landing): the
# surplus columns of the 3-MEDIUM layout folded into additional_column.
ACCEPTED_SALE = """
  SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost,
         CASE WHEN desk = '3-MEDIUM' THEN concat_ws(', ', payment_mode, coupon) END AS additional_column
  FROM sale_extras WHERE desk IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""


def sql(body: str, *views: str, sale: str | None = None) -> str:
    """``WITH`` the named views (and what they depend on), then ``body``.
    ``sale`` replaces the body of the ``sale`` view (it may use
    ``sale_extras``)."""
    names = _order(list(views))
    if sale is not None and "sale" in names:
        names = _order(["sale_extras"]) + [n for n in names if n not in ("sale_lines", "sale_extras")]
    parts = []
    for v in names:
        body_v = sale if (v == "sale" and sale is not None) else _VIEWS[v]
        parts.append(f"{v} AS ({body_v}\n)")
    ctes = ",\n".join(parts)
    return f"WITH {ctes}\n{body}" if ctes else body
