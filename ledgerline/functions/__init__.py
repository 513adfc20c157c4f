from .dates import add_months_overflow, iso_date, month_start, slashed_date
from .keys import surrogate_key

__all__ = ["add_months_overflow", "iso_date", "month_start", "slashed_date", "surrogate_key"]
