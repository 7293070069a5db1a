"""Where events come from and where they are kept."""
