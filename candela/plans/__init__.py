"""The driver-table adapter, the registered queries and their SQL oracles."""
