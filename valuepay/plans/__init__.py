"""Plans: marts, dashboard cards, scenario sweep, quality gates and the refresh job."""
