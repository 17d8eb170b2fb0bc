"""Column-expression helpers. All are built-in Spark expressions, so they
stay inside whole-stage codegen."""

from rankforge.functions.columns import (  # noqa: F401
    as_col,
    equal_width_bin,
    is_integer_text,
    md5_key,
    null_safe_join,
    nullif_zero,
    ratio,
    round6,
    safe_corr,
    sanitize_name,
    unpivot_long,
)
