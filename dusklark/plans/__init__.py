"""Registered queries: each module offers ``QUERIES`` (name -> callable of session and folder) and ``SQL`` (name -> text)."""
