"""DataFrame -> DataFrame operators: typing, history, key resolution, exposure, checks."""
