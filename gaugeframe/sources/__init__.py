from gaugeframe.sources.scratch import materialize, scratch_path
from gaugeframe.sources.tables import (
    Roles,
    column_roles,
    load_model,
    load_table,
    save_model,
    write_metrics,
    write_profile,
    write_splits,
)

__all__ = [
    "Roles", "column_roles", "load_model", "load_table", "materialize", "save_model",
    "scratch_path", "write_metrics", "write_profile", "write_splits",
]
