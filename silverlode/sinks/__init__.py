from silverlode.sinks.releases import delete_releases, read_release, verify_release, write_release
from silverlode.sinks.tables import ROWS_PER_FILE, write_bronze, write_silver

__all__ = ["ROWS_PER_FILE", "delete_releases", "read_release", "verify_release", "write_bronze", "write_release", "write_silver"]
