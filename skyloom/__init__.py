"""Bulk planning and answering of gridded and point data requests on Spark."""
