from silverlode.sources.bronze import check_footers, column_shares, scan_bronze
from silverlode.sources.csv import read_csv

__all__ = ["check_footers", "column_shares", "read_csv", "scan_bronze"]
