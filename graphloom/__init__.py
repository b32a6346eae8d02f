"""graphloom: Spark jobs that turn event pages into a property graph and query it."""
