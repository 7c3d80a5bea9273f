"""Readers.  Each module splits reading (files to raw rows) from mapping (raw rows to
the fixed schema), so the mapping also runs on rows that come from a table."""
