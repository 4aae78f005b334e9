"""Sources (driver tables, derived input views, dated scans) and sinks."""

from .fixtures import Fixtures, duck_fixture_sql, duck_with, fixture  # noqa: F401
from .snapshot import answered, by_position, dated_scan, not_null  # noqa: F401
from .tables import TableSet  # noqa: F401
