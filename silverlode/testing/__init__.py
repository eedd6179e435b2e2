"""Bronze-shaped inputs made from the benchmark tables, and the SQL that says what must come out."""
