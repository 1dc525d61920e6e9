"""Sale records derived from the test tables, the warehouse loaded from them, and oracles."""
