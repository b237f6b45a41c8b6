"""The engine's operators and jobs run over the given test tables, with their SQL counterparts."""
