"""Reading and writing tables: CSV loads, landed files, snapshots, profiles."""
