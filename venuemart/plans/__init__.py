"""The user-level marts and the jobs that read, call and write them."""
