"""Security-event analytics on Spark: strict ingestion, cleaning, enrichment,
scoring, detectors, interval joins, lake and warm-table sinks, BI views."""
