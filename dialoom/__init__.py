"""dialoom: dialogue analytics as Spark DataFrame operators."""
