"""starloom: retail and rental analytics expressed as Spark DataFrame jobs.

Layers:
  sources    readers for the flat extract, lookups and the rental files, plus
             analog views over the TPC-H style test tables
  functions  column-level helpers (exact rounding, labels)
  operators  reusable DataFrame -> DataFrame operators (dense keys, repairs,
             audits, top-N)
  plans      compositions: report pack, star models v1/v2, marts, rental marts
"""

__all__ = ["session", "sources", "functions", "operators", "plans"]
