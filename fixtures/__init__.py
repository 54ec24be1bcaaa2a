"""Made-up flaws: the driver tables written out as the messy extracts that the ETL is tested on."""
