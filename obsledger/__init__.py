"""Spark-native ledger of timed observations.

CSV drops of two families (standby and priority) arrive per property; the
package turns them into one de-duplicated four-column table, keeps the table
current from changed files only, and derives the reports on top of it.
"""

from obsledger.schema import FACT_SCHEMA, KEYS

__all__ = ["FACT_SCHEMA", "KEYS"]
