"""Operators: layout, latest-wins merge, rows/cells reshape, lookups and scans."""
