"""From orders, payments and actions to product statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martflow.operators import orders, stats


def product_measures(
    pages: DataFrame,
    wide: DataFrame,
    paid: DataFrame,
    carts: DataFrame,
    favors: DataFrame,
    refunds: DataFrame,
    comments: DataFrame,
) -> DataFrame:
    """The measures of the seven sources as one frame."""
    return stats.product_union(
        *product_frames(pages, wide, paid, carts, favors, refunds, comments)
    )


def product_frames(
    pages: DataFrame,
    wide: DataFrame,
    paid: DataFrame,
    carts: DataFrame,
    favors: DataFrame,
    refunds: DataFrame,
    comments: DataFrame,
) -> list[DataFrame]:
    """The measures of the seven sources, a frame each; a stream dates each by itself."""
    shown = stats.product_displays(pages)
    return [
        stats.product_clicks(pages).unionByName(shown, allowMissingColumns=True),
        stats.product_orders(wide),
        stats.product_payments(paid),
        stats.product_carts(carts),
        stats.product_favors(favors),
        stats.product_refunds(refunds),
        stats.product_comments(comments),
    ]


def with_product_dimension(product_rows: DataFrame, products: DataFrame) -> DataFrame:
    """Names and price on aggregated rows: far fewer than the facts."""
    return orders.with_product(product_rows, products, price=True)
