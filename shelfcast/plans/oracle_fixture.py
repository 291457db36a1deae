"""The FIXTURES.md §2 mapping written as plain SQL (DuckDB dialect).

The oracle side of every registered query starts from these CTEs over the
driver's pre-registered views (part, lineitem, region, orders, ...). They are
independent of the Spark code in ``shelfcast.sources.testdata``.
"""

from __future__ import annotations

from shelfcast.params import Params
from shelfcast.sources.testdata import FIXTURE_PARAMS


def d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def ts(x) -> str:
    return f"TIMESTAMP '{x.strftime('%Y-%m-%d %H:%M:%S')}'"


def fixture_ctes(grain: str = "bt", p: Params = FIXTURE_PARAMS) -> list[str]:
    vid = "p_brand || '|' || p_type" if grain == "bt" else "CAST(p_partkey AS VARCHAR)"
    return [
        f"""part_v AS (
  SELECT p_partkey, p_brand, p_type, p_retailprice, {vid} AS variant_id,
         CASE WHEN p_type = 'SMALL' THEN '' ELSE p_type END AS sku_label
  FROM part)""",
        """variants_k AS (
  SELECT variant_id, min(sku_label) AS sku, min(p_type) AS title, min(p_retailprice) AS price,
         min(p_partkey) AS k, min(p_brand) AS vendor
  FROM part_v GROUP BY variant_id)""",
        """variants AS (
  SELECT variant_id, variant_id AS product_id, sku, title, price,
         'inv' || CAST(k AS VARCHAR) AS inventory_item_id
  FROM variants_k)""",
        f"""products AS (
  SELECT variant_id AS product_id, 'Product ' || variant_id AS title, vendor, 'ACTIVE' AS status,
         TIMESTAMP '2000-01-01 00:00:00' AS created_at, {ts(p.run_ts)} AS updated_at
  FROM variants_k)""",
        """locations AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS location_id, r_name AS name, r_regionkey <> 4 AS active
  FROM region)""",
        """brands AS (
  SELECT vendor_name, CAST(substr(vendor_name, 7) AS INTEGER) AS n
  FROM (SELECT DISTINCT p_brand AS vendor_name FROM part))""",
        """vendors_existing AS (
  SELECT CAST(n AS BIGINT) AS vendor_id, vendor_name,
         CAST(CASE WHEN n % 5 = 0 THEN NULL ELSE 3 + n % 6 END AS BIGINT) AS lead_time_days,
         CAST(CASE WHEN n % 6 = 0 THEN NULL ELSE 4 + n % 9 END AS BIGINT) AS moq,
         CAST(CASE WHEN n % 4 = 0 THEN NULL ELSE 1 + n % 12 END AS BIGINT) AS pack_size
  FROM brands WHERE n <= 22)""",
        """vendor_status_existing AS (
  SELECT vendor_name,
         CAST(CASE WHEN n % 11 = 0 THEN TRUE WHEN n % 7 = 0 THEN NULL ELSE FALSE END AS BOOLEAN) AS archived,
         CASE WHEN n % 11 = 0 THEN TIMESTAMP '2001-10-01 00:00:00' END AS archived_at,
         CASE WHEN n % 11 = 0 THEN 'stop reordering' END AS note
  FROM brands WHERE n <= 22)""",
        """sales_fx AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS sale_id,
         CAST(l_orderkey AS VARCHAR) AS order_id, '#' || CAST(l_orderkey AS VARCHAR) AS order_name,
         pv.variant_id, pv.sku_label AS sku, 'Product ' || pv.variant_id AS product_title,
         CAST(l_quantity AS BIGINT) AS quantity_sold, CAST(l_shipdate AS DATE) AS sale_date,
         CAST(l_shipdate AS TIMESTAMP) AS sale_timestamp, pv.p_brand AS vendor,
         CAST(NULL AS DECIMAL(38,9)) AS line_price, l_linenumber
  FROM lineitem JOIN part_v pv ON l_partkey = pv.p_partkey)""",
        """sales AS (
  SELECT sale_id, order_id, order_name, variant_id, sku, product_title, quantity_sold, sale_date,
         sale_timestamp, vendor, line_price
  FROM sales_fx)""",
        f"""inventory AS (
  SELECT variant_id || '_' || CAST(r_regionkey AS VARCHAR) || '_' || CAST(snapshot_date AS VARCHAR) AS snapshot_id,
         variant_id, sku, CAST(r_regionkey AS VARCHAR) AS location_id,
         CAST((k * 37 + r_regionkey * 11 + off * 5) % 60 - 25 AS BIGINT) AS available_qty,
         CAST(k % 7 AS BIGINT) AS incoming_qty, CAST(k % 3 AS BIGINT) AS committed_qty,
         snapshot_date, CAST(snapshot_date AS TIMESTAMP) AS snapshot_timestamp
  FROM (SELECT v.variant_id, v.sku, v.k, s.r_regionkey, o.off,
               CAST({d(p.as_of)} - o.off AS DATE) AS snapshot_date
        FROM (SELECT DISTINCT pv.variant_id, n.n_regionkey AS r_regionkey
              FROM lineitem JOIN part_v pv ON pv.p_partkey = l_partkey
              JOIN supplier ON s_suppkey = l_suppkey JOIN nation n ON n.n_nationkey = s_nationkey) s
        JOIN variants_k v ON v.variant_id = s.variant_id, (VALUES (1), (8), (15)) o(off)))""",
        """order_flags AS (
  SELECT o_orderkey, o_orderstatus = 'P' AS cancelled, o_orderkey % 97 = 0 AS test FROM orders)""",
    ]


class FixtureSQL:
    """Oracle SQL over the fixture mapping; rendered per grain."""

    def __init__(self, body_ctes: list[str], select: str, p: Params = FIXTURE_PARAMS):
        self.body, self.select, self.p = list(body_ctes), select, p

    def render(self, grain: str = "bt") -> str:
        return "WITH " + ",\n".join(fixture_ctes(grain, self.p) + self.body) + "\n" + self.select

    def __str__(self) -> str:
        return self.render("bt")


def with_fixture(body_ctes: list[str], select: str, p: Params = FIXTURE_PARAMS) -> FixtureSQL:
    return FixtureSQL(body_ctes, select, p)
