"""Payment-stream analytics on Spark: landing, enrichment, fraud detection, Silver and Gold marts."""
