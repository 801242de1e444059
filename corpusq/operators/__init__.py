"""DataFrame-to-DataFrame operators; each composes with ``df.transform``."""
