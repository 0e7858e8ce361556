"""Order report and saved SQL reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.files import write_format


def order_report(
    orders: DataFrame, details: DataFrame, since: Column, order_key: str, detail_key: str,
    product: str, date: str, amount: Column,
) -> DataFrame:
    """Lines and amount per product over the orders after a date.

    Orders without lines are counted under a NULL product, as a left outer
    join does.  They are found by an anti join of their own, because Spark
    can split a skewed order's lines in an inner join but not on the right of
    an outer one.  Filter and column selection reach all scans; the grouping
    adds up within each task before it shuffles.
    """
    picked = orders.filter(F.col(date) > since).select(F.col(order_key).alias("__order"))
    lines = details.select(F.col(detail_key).alias("__line"), F.col(product), amount.alias("__amount"))
    same = F.col("__order") == F.col("__line")
    found = picked.join(lines, same).select(
        product, F.lit(1).alias("order_lines"), F.lit(1).alias("detail_lines"), "__amount"
    )
    without = picked.join(lines.select("__line").distinct(), same, "left_anti").agg(
        F.count(F.lit(1)).alias("order_lines")
    )
    orphans = without.filter(F.col("order_lines") > 0).select(
        F.lit(None).cast(details.schema[product].dataType).alias(product),
        "order_lines",
        F.lit(0).alias("detail_lines"),
        F.lit(None).cast(found.schema["__amount"].dataType).alias("__amount"),
    )
    return found.unionByName(orphans).groupBy(product).agg(
        F.sum("order_lines").alias("order_lines"),
        F.sum("detail_lines").alias("detail_lines"),
        F.sum("__amount").alias("amount"),
    )


@dataclass(frozen=True)
class SavedReport:
    """A stored report: SQL text or a file holding it, and where the result goes."""

    query_type: str
    query_loc: str
    output_loc: str
    subject: str = ""
    fmt: str = "parquet"

    def text(self, spark: SparkSession) -> str:
        if self.query_type == "file":
            return spark.read.text(self.query_loc, wholetext=True).first()[0]
        return self.query_loc

    def run(self, spark: SparkSession, views: dict[str, DataFrame] = {}) -> DataFrame:
        """Run the report over the given views without storing it."""
        return spark.sql(self.text(spark), **views) if views else spark.sql(self.text(spark))

    def store(self, spark: SparkSession, views: dict[str, DataFrame] = {}) -> None:
        write_format(self.run(spark, views), self.fmt, self.output_loc)
