"""File readers and writers, saved pages, fetch frontier."""
