"""Column-expression helpers (no Python UDFs)."""

from auric.functions.casts import (  # noqa: F401
    bigint_half_even,
    safe_bool,
    safe_date,
    safe_double,
)
from auric.functions.normalize import (  # noqa: F401
    normalize_record,
    parse_cursor,
    text_or_null,
)
