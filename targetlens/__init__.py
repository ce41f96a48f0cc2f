"""targetlens: one row per gene with boolean target criteria and readable evidence, on Spark."""
