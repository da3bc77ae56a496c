from tabprep.sources.csv import (
    FOREST_TAG,
    LOGISTIC_TAG,
    NETWORK_TAG,
    scan_csv,
    scan_labelled,
    submission_path,
    write_csv,
    write_one_csv,
    write_submission,
)
from tabprep.sources.multiline import scan_multiline_csv
from tabprep.sources.tables import scan_table

__all__ = [
    "FOREST_TAG",
    "LOGISTIC_TAG",
    "NETWORK_TAG",
    "scan_csv",
    "scan_labelled",
    "scan_multiline_csv",
    "scan_table",
    "submission_path",
    "write_csv",
    "write_one_csv",
    "write_submission",
]
