"""Writers of tables, text files and documents."""
