"""Job plans: the two batch jobs and the registered driver queries."""
