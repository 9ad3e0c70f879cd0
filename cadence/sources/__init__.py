from cadence.sources.tables import (  # noqa: F401
    customers,
    log_profile,
    log_types,
    raw_transactions,
    read_table,
    source_profile,
    table_profile,
    transactions,
)
from cadence.sources.sinks import load_result, save_model, save_result  # noqa: F401
