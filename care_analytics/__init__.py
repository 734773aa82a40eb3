"""care_analytics: care-administration reporting as Spark DataFrame plans.

Layers:

* ``sources``   – load the reference tables (or the test adapters over the
  driver's Parquet) into a :class:`~care_analytics.sources.catalog.Tables`.
* ``functions`` – driver-side parameter parsing and column-level helpers.
* ``operators`` – reusable DataFrame operators (validity joins, latest row per
  key, flexible filters, joined lists, ...).
* ``plans``     – the fifteen reports composed from the operators, plus one
  query per operator used by the correctness gate.
"""

from care_analytics.sources.catalog import Tables  # noqa: F401

__all__ = ["Tables"]
