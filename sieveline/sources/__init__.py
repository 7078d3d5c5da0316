"""Reading and writing: snapshots, named tables, keyed logs, run log."""
