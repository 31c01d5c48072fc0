"""DataFrame -> DataFrame steps, for ``DataFrame.transform``."""
