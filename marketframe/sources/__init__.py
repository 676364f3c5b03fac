"""Inputs: raw message logs, short rates, error codes, XML documents, delimited lists."""
