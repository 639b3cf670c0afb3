"""Writers: row store, topics, snapshots and reports."""
