"""The given tables seen as bronze events, and the SQL the results must equal."""
