"""Sources: table definitions (S5), delimited extracts (S1), driver tables and fixture frames."""

from tierline.sources.delimited import CORRUPT_COLUMN, read_extract, write_extract
from tierline.sources.fixtures import FIXED_AS_OF, fixture, fixtures, read_table
from tierline.sources.schemas import BRONZE, SILVER, SOURCE_FILES, table_ddl

__all__ = ["BRONZE", "SILVER", "SOURCE_FILES", "table_ddl", "read_extract", "write_extract",
           "CORRUPT_COLUMN", "fixture", "fixtures", "read_table", "FIXED_AS_OF"]
