"""The steps from raw tables to the transaction fact, the monthly mart and the metrics."""
