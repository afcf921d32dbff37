"""Layer builds (silver, gold), documented reports and maintenance."""
