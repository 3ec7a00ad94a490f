"""Marlstone: document-to-record analytics on Spark DataFrames."""
