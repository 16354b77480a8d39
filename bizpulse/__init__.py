"""Business-review analytics as Spark DataFrame jobs: raw -> bronze -> silver -> gold -> serving."""
