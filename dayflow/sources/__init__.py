"""Sources and sinks: Parquet tables, CSV round trips, model sets."""

from dayflow.sources.tables import TABLES, load  # noqa: F401
from dayflow.sources.files import read_csv, write_csv  # noqa: F401
