"""End-to-end plans: the medallion run and the registered query catalog."""
