"""casemill: synthetic clinical cohorts drawn from aggregate coding statistics, on PySpark."""
