"""Map the driver's TPC-H-style tables onto the retail input tables.

The mapping is the one written down in FIXTURES.md §2. Two grains:

* ``bt``   — ``variant_id = p_brand || '|' || p_type`` (≤150 dense series)
* ``part`` — ``variant_id = cast(p_partkey as string)`` (sparse long tail,
  grows with the part table)

Everything here is lazy DataFrame code; nothing is collected.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.semantics import date_lit, ts_lit
from shelfcast.params import Params

# Fixed values of the fixture mapping (FIXTURES.md §2).
FIXTURE_PARAMS = Params(as_of=dt.date(2001, 11, 5), run_ts=dt.datetime(2001, 11, 5), internal_vendors=("Brand#1",))
SNAPSHOT_OFFSETS_DAYS = (1, 8, 15)
EXISTING_VENDOR_MAX_N = 22
INACTIVE_REGIONKEY = 4
PRODUCT_CREATED_AT = dt.datetime(2000, 1, 1)
ARCHIVED_AT = dt.datetime(2001, 10, 1)
ARCHIVE_NOTE = "stop reordering"
TEST_ORDER_MODULUS = 97
CANCELLED_STATUS = "P"


def variant_key(grain: str):
    if grain == "bt":
        return F.concat(F.col("p_brand"), F.lit("|"), F.col("p_type"))
    if grain == "part":
        return F.col("p_partkey").cast("string")
    raise ValueError(f"unknown grain {grain!r}")


class Fixture:
    """Lazily built retail tables over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, grain: str = "bt", params: Params = FIXTURE_PARAMS):
        self.spark, self.sf_dir, self.grain, self.p = spark, sf_dir.rstrip("/"), grain, params

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------------ dimensions
    @cached_property
    def part_v(self) -> DataFrame:
        return self.table("part").select(
            "p_partkey", "p_brand", "p_type", "p_retailprice",
            variant_key(self.grain).alias("variant_id"),
            F.when(F.col("p_type") == "SMALL", F.lit("")).otherwise(F.col("p_type")).alias("sku_label"))

    @cached_property
    def variants_k(self) -> DataFrame:
        return self.part_v.groupBy("variant_id").agg(
            F.min("sku_label").alias("sku"), F.min("p_type").alias("title"),
            F.min("p_retailprice").alias("price"), F.min("p_partkey").alias("k"),
            F.min("p_brand").alias("vendor"))

    @cached_property
    def variants(self) -> DataFrame:
        return self.variants_k.select(
            "variant_id", F.col("variant_id").alias("product_id"), "sku", "title", "price",
            F.concat(F.lit("inv"), F.col("k").cast("string")).alias("inventory_item_id"))

    @cached_property
    def products(self) -> DataFrame:
        return self.variants_k.select(
            F.col("variant_id").alias("product_id"),
            F.concat(F.lit("Product "), F.col("variant_id")).alias("title"),
            "vendor", F.lit("ACTIVE").alias("status"),
            ts_lit(PRODUCT_CREATED_AT).alias("created_at"), ts_lit(self.p.run_ts).alias("updated_at"))

    @cached_property
    def locations(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("string").alias("location_id"), F.col("r_name").alias("name"),
            (F.col("r_regionkey") != INACTIVE_REGIONKEY).alias("active"))

    @cached_property
    def brands(self) -> DataFrame:
        return (self.table("part").select(F.col("p_brand").alias("vendor_name")).distinct()
                .withColumn("n", F.substring("vendor_name", 7, 10).cast("int")))

    @cached_property
    def vendors_existing(self) -> DataFrame:
        n = F.col("n")
        return self.brands.filter(n <= EXISTING_VENDOR_MAX_N).select(
            n.cast("bigint").alias("vendor_id"), "vendor_name",
            F.when(n % 5 == 0, F.lit(None)).otherwise(3 + n % 6).cast("bigint").alias("lead_time_days"),
            F.when(n % 6 == 0, F.lit(None)).otherwise(4 + n % 9).cast("bigint").alias("moq"),
            F.when(n % 4 == 0, F.lit(None)).otherwise(1 + n % 12).cast("bigint").alias("pack_size"))

    @cached_property
    def vendor_status_existing(self) -> DataFrame:
        n = F.col("n")
        archived = F.when(n % 11 == 0, F.lit(True)).when(n % 7 == 0, F.lit(None)).otherwise(F.lit(False))
        return self.brands.filter(n <= EXISTING_VENDOR_MAX_N).select(
            "vendor_name", archived.cast("boolean").alias("archived"),
            F.when(n % 11 == 0, ts_lit(ARCHIVED_AT)).alias("archived_at"),
            F.when(n % 11 == 0, F.lit(ARCHIVE_NOTE)).alias("note"))

    # ------------------------------------------------------------------ facts
    @cached_property
    def sale_lines(self) -> DataFrame:
        """Order lines with their variant, before the ids and titles that `sales` spells out: what a shuffle carries."""
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
        pv = self.part_v.select("p_partkey", "p_brand", "variant_id", "sku_label")
        return li.join(pv, li.l_partkey == pv.p_partkey, "inner").select(
            "l_orderkey", "l_linenumber", "variant_id", F.col("sku_label").alias("sku"), F.col("p_brand").alias("vendor"),
            F.col("l_quantity").cast("bigint").alias("quantity_sold"), "l_shipdate")

    @cached_property
    def sales(self) -> DataFrame:
        return self.sale_lines.select(
            F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("sale_id"),
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.concat(F.lit("#"), F.col("l_orderkey").cast("string")).alias("order_name"),
            "variant_id", "sku", F.concat(F.lit("Product "), F.col("variant_id")).alias("product_title"), "quantity_sold",
            F.col("l_shipdate").cast("date").alias("sale_date"),
            F.col("l_shipdate").cast("timestamp").alias("sale_timestamp"),
            "vendor", F.lit(None).cast("decimal(38,9)").alias("line_price"),
            "l_linenumber")

    @cached_property
    def stocked(self) -> DataFrame:
        """(variant, region) pairs that are stocked, with the variant's sku and number: `inventory` before its dates."""
        # A variant is stocked in the regions whose suppliers ship it: the (variant,
        # region) pairs that the order lines hold, on each of the 3 snapshot dates.
        shipped = (self.table("lineitem").select("l_partkey", "l_suppkey")
                   .join(self.part_v.select(F.col("p_partkey").alias("l_partkey"), "variant_id"), "l_partkey")
                   .join(self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
                   .join(self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"),
                                                     F.col("n_regionkey").alias("r_regionkey")), "s_nationkey")
                   .select("variant_id", "r_regionkey").distinct())
        return shipped.join(self.variants_k.select("variant_id", "sku", "k"), "variant_id")

    @cached_property
    def inventory(self) -> DataFrame:
        return self.snapshots_of(self.stocked)

    def kept_inventory(self, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """`inventory` for a run that reads it more than once: ``keep`` stores the pairs under a name."""
        return self.snapshots_of(keep(self.stocked, "stocked"))

    def snapshots_of(self, stocked: DataFrame) -> DataFrame:
        """Each stocked pair on each of the 3 snapshot dates."""
        offs = F.explode(F.array(*[F.lit(o) for o in SNAPSHOT_OFFSETS_DAYS])).alias("off")
        base = stocked.select("*", offs)
        snap_date = F.date_sub(date_lit(self.p.as_of), F.col("off"))
        return base.select(
            F.concat_ws("_", "variant_id", F.col("r_regionkey").cast("string"), snap_date.cast("string")).alias("snapshot_id"),
            "variant_id", "sku", F.col("r_regionkey").cast("string").alias("location_id"),
            ((F.col("k") * 37 + F.col("r_regionkey") * 11 + F.col("off") * 5) % 60 - 25).cast("bigint").alias("available_qty"),
            (F.col("k") % 7).cast("bigint").alias("incoming_qty"),
            (F.col("k") % 3).cast("bigint").alias("committed_qty"),
            snap_date.alias("snapshot_date"),
            snap_date.cast("timestamp").alias("snapshot_timestamp"))

    @cached_property
    def order_flags(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            F.col("o_orderkey"),
            (F.col("o_orderstatus") == CANCELLED_STATUS).alias("cancelled"),
            (F.col("o_orderkey") % TEST_ORDER_MODULUS == 0).alias("test"))

    def sales_table(self) -> DataFrame:
        """Sales in the stored table's column order (fixture helper column dropped)."""
        return self.sales.drop("l_linenumber")


class StoredFixture(Fixture):
    """The same tables read back from a shelfcast store (see ``land``).

    Facts are date-partitioned Parquet, so date predicates prune directories
    and the latest-snapshot scalar subquery prunes to one partition.
    """

    DIMENSIONS = ("variants", "products", "locations", "vendors_existing", "vendor_status_existing")

    def __init__(self, spark: SparkSession, sf_dir: str, store_dir: str, grain: str = "bt",
                 params: Params = FIXTURE_PARAMS):
        super().__init__(spark, sf_dir, grain, params)
        self.store_dir = store_dir.rstrip("/")

    def _dim(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.store_dir}/{name}")

    variants = cached_property(lambda self: self._dim("variants"))
    products = cached_property(lambda self: self._dim("products"))
    locations = cached_property(lambda self: self._dim("locations"))
    vendors_existing = cached_property(lambda self: self._dim("vendors_existing"))
    vendor_status_existing = cached_property(lambda self: self._dim("vendor_status_existing"))

    @cached_property
    def sales(self) -> DataFrame:
        from shelfcast.sources.store import table_schema
        s = self.spark.read.schema(table_schema("sales_history_raw")).parquet(f"{self.store_dir}/sales_history_raw")
        return s.withColumn("l_linenumber", F.element_at(F.split("sale_id", "_"), -1).cast("int"))

    @cached_property
    def sale_lines(self) -> DataFrame:
        return self.sales.select(F.col("order_id").cast("bigint").alias("l_orderkey"), "l_linenumber", "variant_id", "sku", "vendor",
                                 "quantity_sold", F.col("sale_timestamp").alias("l_shipdate"))

    @cached_property
    def inventory(self) -> DataFrame:
        from shelfcast.sources.store import table_schema
        return self.spark.read.schema(table_schema("inventory_snapshots_raw")).parquet(
            f"{self.store_dir}/inventory_snapshots_raw")

    def kept_inventory(self, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        return self.inventory


def land(fixture: Fixture, store_dir: str) -> None:
    """Write the fixture's input tables into a store: dimensions whole, facts date-partitioned."""
    from shelfcast.sources import store
    for name in StoredFixture.DIMENSIONS:
        getattr(fixture, name).write.mode("overwrite").parquet(f"{store_dir}/{name}")
    store.write_fact(fixture.sales_table(), f"{store_dir}/sales_history_raw", "sales_history_raw")
    store.write_fact(fixture.inventory, f"{store_dir}/inventory_snapshots_raw", "inventory_snapshots_raw")
