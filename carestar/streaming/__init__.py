"""File-stream form of the extract."""
