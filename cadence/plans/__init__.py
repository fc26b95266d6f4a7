"""Query plans over the warehouse: staging views, marts, the batch job."""
