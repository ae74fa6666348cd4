"""Customer-feedback analytics on Spark: land archives, parse, translate, score, report."""
