"""Jobs: cleaning, staging, marts, reports, exploration, quality."""
