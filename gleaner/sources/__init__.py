"""Scans: landed feed files (XML, batch or stream), pages, ledger, queue
snapshots and model responses."""
