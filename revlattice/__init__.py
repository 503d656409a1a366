"""Go-to-market analytics as Spark jobs: accounts, usage, revenue history, activation."""
