"""Recurring-billing event analytics on Spark.

Three tables are kept right from an append-only event log whose rows may arrive late, out of order
or more than once: an event history, the current state of every subscription, and daily KPIs.
"""
