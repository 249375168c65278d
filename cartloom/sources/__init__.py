"""Scans: landed search responses, flat pipe files, driver tables, day spines."""
