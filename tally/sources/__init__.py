"""Tables on disk, landed broker files and payload parsing."""
