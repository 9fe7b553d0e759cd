from gridloom.sources import fixtures, raw, snapshot  # noqa: F401
