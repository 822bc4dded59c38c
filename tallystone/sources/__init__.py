"""Reading exports and keeping the tables a job writes."""
