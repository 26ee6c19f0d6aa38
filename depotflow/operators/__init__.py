"""Table-to-table building blocks shared by the plans."""
