"""Sources: raw CSV, the driver-table mapping, stored tables, JDBC."""

from farelens.sources.csv import check_source_file, map_columns, read_csv_text, read_raw_csv  # noqa: F401
from farelens.sources.mapping import raw_from_tpch  # noqa: F401
from farelens.sources.staging import conform, raw_column_name, stage  # noqa: F401
from farelens.sources.tables import read_fact, read_jdbc, read_staging  # noqa: F401
