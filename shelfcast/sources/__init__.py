from shelfcast.sources.models import cluster_path, load_model, load_models, save_model
from shelfcast.sources.tables import (
    conform,
    drop_staged,
    load_config,
    read_delimited,
    read_table,
    save_series_table,
    shared_dir,
    stage,
    with_position,
    write_csv,
    write_parquet,
)
from shelfcast.sources.versions import latest_version, publish_version, read_version, update_versioned

__all__ = [
    "cluster_path",
    "conform",
    "drop_staged",
    "latest_version",
    "load_config",
    "load_model",
    "load_models",
    "publish_version",
    "read_delimited",
    "read_table",
    "read_version",
    "save_model",
    "save_series_table",
    "shared_dir",
    "stage",
    "update_versioned",
    "with_position",
    "write_csv",
    "write_parquet",
]
