"""Job plans (the load job, its command line) and physical-plan checks."""
