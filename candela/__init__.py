"""candela: minute-candle (OHLCV) analytics as plain Spark DataFrame functions.

Layers:
  sources/    readers for archive CSV, live JSON messages, metadata documents, zip archives
  functions/  column expressions shared by every operator (epochs, decimals, ratios, time parts)
  operators/  DataFrame -> DataFrame steps: bronze, stage, rules, upsert, dedup, dims, fact,
              rollup, gaps, monitors, manifest, serve
  streaming/  Structured Streaming runners over the same operators
  plans/      the driver-table adapter, the registered queries and their SQL oracles
"""

__version__ = "0.1.0"
