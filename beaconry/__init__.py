"""Personalised-messaging analytics as Spark DataFrame operators."""
