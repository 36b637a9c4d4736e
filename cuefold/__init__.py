"""cuefold: timed-transcript analytics as composable PySpark DataFrame functions."""
