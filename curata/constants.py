"""Fixed values shared by the loaders.

Fixed values (these must stay as they are for results to agree):
  OPEN_END      = 9999-12-31            open end of a validity interval
  MIN_DATE      = 1900-01-01            start of a late-arriving member
  NA            = 'NA'                  attribute value of a late-arriving member
  control columns of a loaded table:
      row_creation_time, file_modification_time, file_path,
      start_time, end_time, is_current, is_deleted
  hash columns: hkey, hdiff; flag column curr_row_flg (Y / N / D)
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"
MIN_DATE = "1900-01-01"
NA = "NA"

CONTROL_COLUMNS = (
    "row_creation_time",
    "file_modification_time",
    "file_path",
    "start_time",
    "end_time",
    "is_current",
    "is_deleted",
)

# System columns left out of a row's hash (valid_flag is the corrected
# spelling of a misspelt name).
HASH_EXCLUDE = (
    "hkey",
    "hdiff",
    "create_date",
    "change_date",
    "curr_row_flg",
    "valid_flag",
    "dq_codes",
    "data_quality_valid_flag",
    "data_quality_result_array",
)


def ts(value: str) -> Column:
    """A timestamp-without-zone literal (the test tables are timestamp_ntz)."""
    return F.lit(value).cast("timestamp_ntz")


def as_of_col(as_of) -> Column:
    """`as_of` may be a Column or a 'yyyy-MM-dd HH:mm:ss' string."""
    if isinstance(as_of, Column):
        return as_of
    return ts(str(as_of))
