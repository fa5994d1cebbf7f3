"""Column -> Column functions; all but the stemmer run inside the JVM."""
