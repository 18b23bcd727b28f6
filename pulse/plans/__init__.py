"""Plans: the registered queries, their SQL oracle, jobs and plan inspection."""
