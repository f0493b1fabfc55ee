"""Readers and writers: files, the driver's tables, snapshots, run log."""
