"""Readers, writers and the shared scratch area."""

from climagrid.sources.readers import (
    read_locations_csv,
    read_locations_jdbc,
    read_observations,
    read_table,
    read_weather_json,
    split_valid_documents,
)
from climagrid.sources.scratch import materialize, scratch_path
from climagrid.sources.writers import (
    export_dataset,
    load_table,
    save_dataset,
    write_locations_csv,
    write_observations,
    write_raw_json,
)

__all__ = [
    "export_dataset",
    "load_table",
    "materialize",
    "read_locations_csv",
    "read_locations_jdbc",
    "read_observations",
    "read_table",
    "read_weather_json",
    "save_dataset",
    "scratch_path",
    "split_valid_documents",
    "write_locations_csv",
    "write_observations",
    "write_raw_json",
]
