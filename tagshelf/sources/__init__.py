"""Reading raw records and tables, publishing snapshots and views."""
