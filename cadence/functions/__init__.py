from cadence.functions.columns import (  # noqa: F401
    days_between,
    is_weekend,
    safe_ratio,
)
from cadence.functions.ordered import (  # noqa: F401
    exact_quantiles, global_row_number, quantile_row, running_totals,
)
