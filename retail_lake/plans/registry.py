"""The registered queries: name -> (callable, check SQL or None)."""

QUERIES = {}
CHECKS = {}


def query(name, check=None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` with the SQL that must give the same rows."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query '{name}' is registered twice")
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn
    return add
