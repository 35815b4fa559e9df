"""Batch analytics on pretrial detention, written as ordinary Spark jobs."""
