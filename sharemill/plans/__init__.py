"""Complete pipelines: tables in, one DataFrame out. Marts that need an intermediate twice stage it."""
