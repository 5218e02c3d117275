"""Writers: insert-if-absent stores, the audit log and versioned snapshots."""
