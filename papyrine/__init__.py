"""Turn scraped document collections into clean text tables, on Spark."""
