"""Flow-record analytics on Spark: filters, aggregators, joins, sources, sinks and alerts as DataFrame plans."""
