"""The nine canonical tables: columns, declared types, keys, physical layout and comments."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Layout:
    """How a table is laid out in files; the columns named here decide what a scan can skip.

    Bucketing on the order id lets items, reviews and payments meet their order without a
    shuffle. It is not the default: a bucket cannot be split, so it suits keys without hot values.

    ``zorder_by`` orders the whole table by the interleaved places of several columns, so that a filter
    on any one of them skips files and row groups; ``bloom`` adds Bloom filters for equality on ids.
    """

    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    sort_by: tuple[str, ...] = ()
    range_clustered: bool = False
    zorder_by: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableSpec:
    name: str
    file_pattern: str
    columns: dict[str, str]
    key: tuple[str, ...] = ()
    layout: Layout = field(default_factory=Layout)
    lookup: tuple[str, ...] = ()
    multi_line: bool = False
    comment: str = ""
    column_comments: dict[str, str] = field(default_factory=dict)


def _typed(kind: str, *names: str) -> dict[str, str]:
    return dict.fromkeys(names, kind)


CUSTOMERS = TableSpec(
    name="customers",
    file_pattern="*customers_dataset.csv",
    columns=_typed(
        "string",
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    ),
    key=("customer_id",),
    layout=Layout(sort_by=("customer_state", "customer_zip_code_prefix")),
    lookup=("customer_unique_id", "customer_state", "customer_zip_code_prefix"),
    comment="One row per order's customer; the unique id is the person behind it",
    column_comments={"customer_unique_id": "The person, the same across that person's orders"},
)
GEOLOCATION = TableSpec(
    name="geolocation",
    file_pattern="*geolocation_dataset.csv",
    columns={
        **_typed("string", "geolocation_zip_code_prefix"),
        **_typed("float", "geolocation_lat", "geolocation_lng"),
        **_typed("string", "geolocation_city", "geolocation_state"),
    },
    layout=Layout(sort_by=("geolocation_zip_code_prefix",)),
    lookup=("geolocation_zip_code_prefix", "geolocation_state"),
    comment="Coordinates seen for a zip code prefix; several rows per prefix",
)
ORDERS = TableSpec(
    name="orders",
    file_pattern="*orders_dataset.csv",
    columns={
        **_typed("string", "order_id", "customer_id", "order_status"),
        **_typed(
            "datetime",
            "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date",
        ),
    },
    key=("order_id",),
    layout=Layout(sort_by=("order_purchase_timestamp",)),
    lookup=("customer_id", "order_status", "order_purchase_timestamp"),
    comment="Fact table: customers, payments, reviews and items all hang off it",
    column_comments={"order_status": "Stage of the order, from created to delivered, or canceled"},
)
ORDER_ITEMS = TableSpec(
    name="order_items",
    file_pattern="*order_items_dataset.csv",
    columns={
        **_typed("string", "order_id"),
        **_typed("int", "order_item_id"),
        **_typed("string", "product_id", "seller_id"),
        **_typed("datetime", "shipping_limit_date"),
        **_typed("float", "price", "freight_value"),
    },
    key=("order_id", "order_item_id"),
    layout=Layout(sort_by=("order_id",)),
    lookup=("order_id", "product_id", "seller_id"),
    comment="Order lines, each one product from one seller",
    column_comments={"order_item_id": "Line number inside the order, starting at 1"},
)
ORDER_PAYMENTS = TableSpec(
    name="order_payments",
    file_pattern="*order_payments_dataset.csv",
    columns={
        **_typed("string", "order_id"),
        **_typed("int", "payment_sequential"),
        **_typed("string", "payment_type"),
        **_typed("int", "payment_installments"),
        **_typed("float", "payment_value"),
    },
    key=("order_id", "payment_sequential"),
    layout=Layout(sort_by=("order_id",)),
    lookup=("order_id", "payment_type"),
    comment="Payments; an order may be paid in several parts",
    column_comments={"payment_sequential": "Number of the payment inside the order"},
)
ORDER_REVIEWS = TableSpec(
    name="order_reviews",
    file_pattern="*order_reviews_dataset.csv",
    columns={
        **_typed("string", "review_id", "order_id"),
        **_typed("int", "review_score"),
        **_typed("string", "review_comment_title", "review_comment_message"),
        **_typed("datetime", "review_creation_date", "review_answer_timestamp"),
    },
    key=("review_id",),
    layout=Layout(sort_by=("order_id",)),
    lookup=("order_id", "review_score", "review_creation_date"),
    multi_line=True,
    comment="Reviews of orders; usually one, sometimes several per order",
)
PRODUCTS = TableSpec(
    name="products",
    file_pattern="*products_dataset.csv",
    columns={
        **_typed("string", "product_id", "product_category_name"),
        **_typed(
            "float",
            "product_name_lenght", "product_description_lenght", "product_photos_qty",
            "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        ),
    },
    key=("product_id",),
    layout=Layout(sort_by=("product_category_name",)),
    lookup=("product_category_name",),
    comment="Catalog of products offered",
)
SELLERS = TableSpec(
    name="sellers",
    file_pattern="*sellers_dataset.csv",
    columns=_typed("string", "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    key=("seller_id",),
    layout=Layout(sort_by=("seller_state", "seller_zip_code_prefix")),
    lookup=("seller_state", "seller_zip_code_prefix"),
    comment="Marketplace sellers",
)
TRANSLATION = TableSpec(
    name="product_category_translation",
    file_pattern="product_category_name_translation.csv",
    columns=_typed("string", "product_category_name", "product_category_name_english"),
    key=("product_category_name",),
    comment="English names of product categories; not every category has one",
)

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        CUSTOMERS, GEOLOCATION, ORDERS, ORDER_ITEMS, ORDER_PAYMENTS, ORDER_REVIEWS, PRODUCTS, SELLERS, TRANSLATION,
    )
}

# (child table, child column, parent table, parent column); documented, never enforced.
LINKS: list[tuple[str, str, str, str]] = [
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
    ("orders", "customer_id", "customers", "customer_id"),
]
