"""DataFrame -> DataFrame operators over the silver table."""
