"""The operators run over the given test tables, with their SQL counterparts."""
