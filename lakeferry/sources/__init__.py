"""Tables, files of every supported format, and trees of non-tabular files."""
