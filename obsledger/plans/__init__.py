"""Jobs: build, update, report, latest, and the daily chain of them."""
