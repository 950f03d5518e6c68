"""Funnel definitions and column-name configuration.

Stage lists and column names are parameters everywhere: the event vocabulary
and the column names differ between data sets (scripts, SQL and dashboard of
the original project each use their own), so nothing below is hard-wired into
an operator.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class FunnelSpec:
    """Ordered funnel stages plus the event-table column names.

    ``stages`` is a tuple of ``(event_name, label)`` pairs in funnel order.
    """

    stages: tuple[tuple[str, str], ...]
    session_col: str = "session_id"
    event_col: str = "event_name"
    ts_col: str = "event_timestamp"
    order_col: str = "event_id"
    props_col: str = "event_properties"

    def __post_init__(self):
        if not self.stages:
            raise ValueError("a funnel needs at least one stage")
        names = [n for n, _ in self.stages]
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate stage names in {names}")

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.stages]

    @property
    def labels(self) -> list[str]:
        return [lbl for _, lbl in self.stages]

    @property
    def n(self) -> int:
        return len(self.stages)

    def flag(self, i: int) -> str:
        """Name of the per-session flag column of stage ``i``."""
        return f"s{i}"

    def flag_cols(self) -> list[str]:
        return [self.flag(i) for i in range(self.n)]

    def with_stages(self, stages) -> "FunnelSpec":
        return FunnelSpec(
            tuple(stages), self.session_col, self.event_col, self.ts_col, self.order_col, self.props_col
        )


@dataclass(frozen=True)
class Roles:
    """Which event names play the roles used by the payment/product/SQL operators."""

    product_view: str = "product_detail_view"
    add_to_cart: str = "add_to_cart"
    checkout: str = "checkout_initiated"
    initiated: str = "payment_initiated"
    failed: str = "payment_failed"
    success: str = "payment_success"
    purchase: str = "payment_success"
    method_selected: str | None = "payment_method_selected"


@dataclass(frozen=True)
class Columns:
    """Names of the order and session columns that differ between data sets."""

    gmv: str = "gmv"
    order_id: str = "order_id"
    order_date: str = "order_date"


# --- fixed values: stage vocabularies of the original project -------------
SCRIPT_STAGES = (
    ("page_view", "Session Started"),
    ("product_listing_view", "Browsed Products"),
    ("product_detail_view", "Viewed Product Detail"),
    ("add_to_cart", "Added to Cart"),
    ("cart_view", "Viewed Cart"),
    ("checkout_initiated", "Started Checkout"),
    ("address_filled", "Filled Address"),
    ("payment_method_selected", "Selected Payment"),
    ("payment_initiated", "Initiated Payment"),
    ("payment_success", "Completed Purchase"),
)
GENERATOR_STAGES = (
    ("page_view", "page_view"),
    ("product_listing_view", "product_listing_view"),
    ("product_detail_view", "product_detail_view"),
    ("add_to_cart", "add_to_cart"),
    ("cart_view", "cart_view"),
    ("checkout_initiated", "checkout_initiated"),
    ("address_filled", "address_filled"),
    ("payment_method_selected", "payment_method_selected"),
    ("order_review", "order_review"),
    ("payment_initiated", "payment_initiated"),
    ("payment_success", "payment_success"),
)
WAREHOUSE_STAGES = (
    ("page_view", "Home Page"),
    ("product_view", "Product Detail"),
    ("add_to_cart", "Cart"),
    ("begin_checkout", "Checkout"),
    ("purchase", "Purchase"),
)
# Event vocabulary of the driver test tables (events.event_type).
DRIVER_STAGES = (
    ("view", "Viewed"),
    ("click", "Clicked"),
    ("signup", "Signed Up"),
    ("purchase", "Purchased"),
)
# ---------------------------------------------------------------------------

PRESETS = {
    "script": FunnelSpec(SCRIPT_STAGES),
    "generator": FunnelSpec(GENERATOR_STAGES),
    "warehouse": FunnelSpec(WAREHOUSE_STAGES, ts_col="timestamp"),
    "driver": FunnelSpec(DRIVER_STAGES),
}

# the warehouse tables name the order's amount differently
WAREHOUSE_COLUMNS = Columns(gmv="order_value")
SCRIPT_ROLES = Roles()
WAREHOUSE_ROLES = Roles(
    product_view="product_view",
    add_to_cart="add_to_cart",
    checkout="begin_checkout",
    initiated="begin_checkout",
    failed="payment_failed",
    success="purchase",
    purchase="purchase",
    method_selected=None,
)
DRIVER_ROLES = Roles(
    product_view="view",
    add_to_cart="click",
    checkout="signup",
    initiated="signup",
    failed="error",
    success="purchase",
    purchase="purchase",
    method_selected="click",
)


def require_columns(df: DataFrame, *cols: str) -> None:
    """Fail early (on the driver, no job) if a column parameter is not in ``df``."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not in {df.columns}")
