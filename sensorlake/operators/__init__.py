"""DataFrame -> DataFrame operators of the landing -> minute -> hour pipeline."""
