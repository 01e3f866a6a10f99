"""civiclens: municipal service-request analytics written as PySpark DataFrame jobs."""
