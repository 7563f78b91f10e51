"""Partitioned tables and the keyed candle log."""
