"""graphloom: a Spark-first engine for turning records and text into queryable knowledge."""
