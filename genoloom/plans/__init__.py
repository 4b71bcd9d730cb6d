"""Named queries over the driver's tables, each beside the SQL that gives the same rows."""
