"""Domain refresh jobs, the query registry and its SQL oracle."""
