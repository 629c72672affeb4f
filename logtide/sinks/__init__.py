"""Writers. Partitioned writers rebalance first, so that a large partition is
written by several tasks and small ones share a task."""
