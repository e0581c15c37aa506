"""Plans: exports made of several operators over one base."""
