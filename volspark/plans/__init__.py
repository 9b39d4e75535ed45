"""Ready-made jobs: the library's operators wired to the star-schema tables, with SQL oracles."""
