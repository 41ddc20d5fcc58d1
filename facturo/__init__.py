"""facturo: invoice-line analytics as lazy Spark DataFrame operators.

Every public operator takes a DataFrame (plus column names, defaulting to the
invoice-line names in :mod:`facturo.schema`) and returns a DataFrame. No
operator triggers a Spark action; the caller decides when to collect, write or
persist.
"""

from facturo.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
