"""Column expressions: dates, text and hashes, numbers and scores, arrays and JSON."""

from . import dates, nested, numeric, text

__all__ = ["dates", "nested", "numeric", "text"]
