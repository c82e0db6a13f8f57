"""Loyalty analytics as lazy PySpark DataFrame operators.

Every operator takes DataFrames plus explicit parameters (above all ``as_of``,
the first day that is *not* part of the data) and returns a lazy DataFrame.
"""

from stampbook.scheme import Scheme
from stampbook.session import build_session

__all__ = ["Scheme", "build_session"]
