"""Column-level helpers and record contracts (pure expressions, no I/O)."""

from strata.functions.contracts import (  # noqa: F401
    BRONZE_CONTRACT, BRONZE_FIELDS, EmptyInputError, SchemaMismatchError, all_strings,
    assert_schema, conform, missing_columns, schema_diff,
)
from strata.functions.columns import (  # noqa: F401
    date_parts, exact_sum, orderable,
)
