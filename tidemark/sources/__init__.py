"""Where rows come from: staged files, document folders and the test tables."""
