"""Writers for tables and result files."""
