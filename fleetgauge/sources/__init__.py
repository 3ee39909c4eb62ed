from .files import read_csv, read_holidays, write_csv, write_parquet  # noqa: F401
from .published import Gate, RefusedError, Versions, publish, read_published  # noqa: F401
from .schemas import common_schema, reconcile  # noqa: F401
from .relational import jdbc_append_once, jdbc_copy, jdbc_read, jdbc_read_balanced, jdbc_write  # noqa: F401
from .scan import (  # noqa: F401
    dated_names,
    extract,
    preview,
    read_days,
    scan_days,
    scan_union,
    schema_report,
    union_all,
)
