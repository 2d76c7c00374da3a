"""ledgerloom: market reference data operators as Spark DataFrame jobs."""
