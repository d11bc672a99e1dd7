"""Ad-session analytics on Spark: sessions, daily mart, campaign and name mappings, file and partition bookkeeping."""
