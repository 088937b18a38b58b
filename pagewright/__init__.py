"""PageWright: a PySpark engine that turns raw web pages into a structured course catalogue."""
