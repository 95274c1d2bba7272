"""SQL twins of the registered reports, for an independent engine to run on the same test tables."""

from oracle.statements import statements  # noqa: F401
