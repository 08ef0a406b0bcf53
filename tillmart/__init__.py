"""Commerce marts on Spark: raw JSON zone, staging tables, funnel and RFM marts."""
