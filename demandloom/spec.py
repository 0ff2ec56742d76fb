"""Names shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

STORE = "internal_store_id"
PRODUCT = "internal_product_id"

# The measures summed per week and the attributes carried along.
MEASURES = ("quantity", "gross_value", "net_value", "gross_profit", "discount", "taxes")
STORE_ATTRIBUTES = ("zipcode", "premise_type", "categoria_pdv")
PRODUCT_ATTRIBUTES = ("categoria", "tipos", "label", "subcategoria", "marca", "fabricante")

# The categories that get integer codes.
CATEGORIES = (
    "categoria", "tipos", "label", "subcategoria", "marca", "fabricante",
    "premise_type", "categoria_pdv",
)

# Lags and rolling windows of the weekly features.
LAGS = (1, 2, 3, 4, 8, 12)
WINDOWS = (2, 4, 8, 12)

UNKNOWN = "Unknown"


@dataclass(frozen=True)
class SeriesSpec:
    """Which columns name a series, order it in time, and hold its value."""

    keys: tuple[str, ...] = (STORE, PRODUCT)
    order_by: tuple[str, ...] = ("year", "week")
    target: str = "quantity"

    @property
    def grain(self) -> tuple[str, ...]:
        return self.keys + self.order_by


WEEKLY = SeriesSpec()
