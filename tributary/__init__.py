"""Funnel and session analytics on web event data, as Spark DataFrame plans."""
