"""Where rows come from: raw files, stored tables, mapped tables, generators."""
