"""DataFrame operators: versions, surrogate keys, lookups, ordered tables."""

from tierforge.operators.keys import surrogate_key  # noqa: F401
from tierforge.operators.ranged import next_rows, ordered_table  # noqa: F401
from tierforge.operators.star import lookup  # noqa: F401
from tierforge.operators.versions import current_only, end_date_versions, keep_latest  # noqa: F401
