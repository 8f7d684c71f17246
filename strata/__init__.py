"""Layered (raw -> typed -> answer) analytics as plain Spark DataFrame operators."""
