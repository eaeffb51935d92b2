"""Where rows go: the landing zone, clean tables and marts, benchmark layouts."""
