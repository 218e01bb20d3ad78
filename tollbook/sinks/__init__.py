"""Writers and the table store."""
