"""Column expressions: all JVM-side, codegen-friendly."""

from fileflow.functions.strftime import (  # noqa: F401
    expand_template,
    resolve_template,
    strftime_col,
    strftime_to_java,
    templated_path_column,
)
from fileflow.functions.text import (  # noqa: F401
    LINE_PATTERN,
    chunk_starts,
    header_block,
    idiv,
    split_lines,
)
