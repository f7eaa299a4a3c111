# the quantile operators stay under marketlens.operators.quantiles (module)
from marketlens.operators.ranking import (  # noqa: F401
    join_on_keys, materialize_small, ntile_of, range_offsets, range_sorted, with_global_ntile,
    with_global_rank, with_global_row_number, with_group_sequence,
)
