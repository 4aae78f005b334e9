"""Column-level functions shared by the operators."""

from .dates import normalise_date_col, normalise_job_date, year_of  # noqa: F401
from .text import before_first, leading_int, split_dropping_trailing  # noqa: F401
