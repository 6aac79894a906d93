"""Encyclopedia dumps to a property graph, on Spark."""
