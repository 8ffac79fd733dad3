"""Sales-versus-targets analytics as lazy Spark DataFrame operators."""
