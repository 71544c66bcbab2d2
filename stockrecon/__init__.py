"""Inventory reconciliation for many clients, expressed as Spark DataFrame jobs."""
