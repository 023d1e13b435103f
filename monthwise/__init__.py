"""monthwise: a Spark-native monthly load engine.

Plan which months are due, scan month files whose schemas differ, conform
them to one typed column contract, gate them, publish or retire each month
safely on repeat, keep a count ledger and reconcile it, draw ordered
samples, write to JDBC, and take in new files as an incremental stream.
"""

from monthwise.contract import LEDGER_SCHEMA, TRIP_CONTRACT, ColumnSpec, Contract
from monthwise.functions.conform import column_or_null, conform

__all__ = ["ColumnSpec", "Contract", "TRIP_CONTRACT", "LEDGER_SCHEMA", "column_or_null", "conform"]
