"""Named query plans over the test tables (the driver's query registry)."""
