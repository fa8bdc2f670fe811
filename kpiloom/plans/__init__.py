"""Plans: derived inputs, the end-to-end medallion run, and the registered check queries."""
