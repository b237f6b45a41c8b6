"""Reading and writing tables and stored documents."""
