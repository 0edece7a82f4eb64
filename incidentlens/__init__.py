"""Student-incident reporting on Spark: scope, reduce, choose, format, sort."""
