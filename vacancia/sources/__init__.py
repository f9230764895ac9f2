"""Reading landing files, reading and writing tables, exporting JSON."""
