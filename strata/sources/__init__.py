"""Reading and writing: landed raw files, dated tables, snapshots, metrics."""
