"""Every query by name, with the SQL it must agree with."""

from variantflow.catalog import files, keyed, stages, text, vectors  # noqa: F401
from variantflow.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
