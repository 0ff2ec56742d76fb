"""Reading the input tables, writing results, and staging intermediate ones."""

from .sinks import write_features, write_forecast_csv, write_processed
from .staging import (
    application_folder, drop_folders, drop_staged, recorded, shared_folder, stage,
)
from .tables import conform, load_tables

__all__ = [
    "application_folder", "conform", "drop_folders", "drop_staged", "load_tables", "recorded", "shared_folder", "stage",
    "write_features", "write_forecast_csv", "write_processed",
]
