"""Reading tables, saving records, and views over the test tables."""
