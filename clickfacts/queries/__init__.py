"""Registered queries over the star-schema tables, each with its SQL counterpart where SQL can express it."""
