"""Stage tables, reports and the runs that keep them up to date."""
