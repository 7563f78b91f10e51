"""Scans: the kline lake, warehouse tables, trade messages, and small inline relations."""
