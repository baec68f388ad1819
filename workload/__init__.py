"""The registered queries, their input tables and their SQL counterparts."""
