"""Plans: table builds, fixtures, the task runner, registered queries and their SQL oracles."""
