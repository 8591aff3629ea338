"""End-to-end jobs and the query registry used by the driver and the bench."""
