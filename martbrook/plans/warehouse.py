"""The layers of the warehouse over one folder of given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import applog, products, visitors, wide
from ..session import written
from ..sources import given

WINDOW = "1 hour"  # the given events are sparse: ten-second windows would hold one row each
BOUNCE_MS = 3_600_000
AS_OF = "2024-01-01"
ORDER = ("ts", "seq")
METRIC_COLUMNS = ("order_id", "detail_id", "sku_id", "sku_num", "split_total_amount", "create_ts")


class Warehouse:
    """Lazy DataFrames for each layer; ``streaming`` reads the given facts as streams."""

    def __init__(self, spark: SparkSession, folder: str, streaming: bool = False) -> None:
        self.spark, self.folder, self.streaming = spark, folder, streaming

    def table(self, name: str) -> DataFrame:
        return given.table(self.spark, self.folder, name)

    def fact(self, name: str) -> DataFrame:
        return given.stream(self.spark, self.folder, name) if self.streaming else self.table(name)

    # inputs
    @cached_property
    def logs(self) -> DataFrame:
        return given.app_log(self.fact("events"))

    @cached_property
    def searched_logs(self) -> DataFrame:
        return given.search_log(self.fact("documents"))

    @cached_property
    def orders(self) -> DataFrame:
        return given.order_info(self.fact("orders"))

    @cached_property
    def details(self) -> DataFrame:
        return given.order_detail(self.fact("lineitem"))

    @cached_property
    def payments(self) -> DataFrame:
        return given.payment_info(self.fact("orders"))

    @cached_property
    def change_text(self) -> DataFrame:
        return given.change_envelopes(self.fact("orders"), self.fact("lineitem"), self.fact("customer"))

    # dimensions
    @cached_property
    def product_dim(self) -> DataFrame:
        part = self.table("part")
        return wide.product_dim(given.sku_dim(part), given.spu_dim(part), given.category3_dim(part),
                                given.trademark_dim(part))

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return {
            "users": given.user_dim(self.table("customer")),
            "provinces": given.province_dim(self.table("nation")),
            "products": self.product_dim,
        }

    # detail and wide layers
    @cached_property
    def pages(self) -> DataFrame:
        return applog.page_logs(self.logs)

    @cached_property
    def order_wide(self) -> DataFrame:
        return wide.order_wide(self.orders, self.details)

    @cached_property
    def order_wide_dims(self) -> DataFrame:
        return wide.with_dimensions(self.order_wide, **self.dims, as_of=AS_OF)

    @cached_property
    def payment_wide(self) -> DataFrame:
        return wide.payment_wide(self.payments, self.order_wide)

    # statistics
    def metrics(self, order_wide: DataFrame | None = None, payment_wide: DataFrame | None = None) -> DataFrame:
        """All seven inputs as metric rows. The wide orders feed two of them, so unless given
        they are written once rather than joined twice."""
        if order_wide is None:
            order_wide = written(self.order_wide.select(*METRIC_COLUMNS), "order_wide")
        if payment_wide is None:
            payment_wide = wide.payment_wide(self.payments, order_wide)
        events, lineitem = self.fact("events"), self.fact("lineitem")
        return products.merged_metrics(
            self.pages, given.mark_info(events), given.after_sale_info(lineitem), order_wide, payment_wide)

    @cached_property
    def product_stats(self) -> DataFrame:
        return products.product_stats_wide(products.product_stats(self.metrics(), WINDOW), self.product_dim)

    @cached_property
    def sales_stats(self) -> DataFrame:
        """Product statistics of orders alone: all that the sales questions read."""
        stats = products.product_stats(products.order_metrics(self.order_wide), WINDOW)
        return products.product_stats_wide(stats, self.product_dim)

    @cached_property
    def sales(self) -> DataFrame:
        """The same for questions about amounts alone: no distinct orders, no names."""
        return products.product_sums(products.order_metrics(self.order_wide), WINDOW)

    @cached_property
    def sales_sums(self) -> DataFrame:
        return products.product_stats_wide(self.sales, self.product_dim)

    @cached_property
    def visitor_stats(self) -> DataFrame:
        """One pass over the log; page views, uniques, bounces and first visits all read the cells it leaves. The flag
        depends on visitor and date alone, so it is repaired once, on the metric rows."""
        cells = written(visitors.visitor_cells(self.logs, WINDOW, BOUNCE_MS), "visitor_cells")
        metrics = visitors.cell_metrics(cells, BOUNCE_MS)
        return visitors.visitor_stats(visitors.repair_flag(metrics, visitors.cell_visits(cells)), WINDOW)
