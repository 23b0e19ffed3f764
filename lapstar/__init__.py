"""Analytics over timed competition results, as Spark jobs."""
