"""Writers. Every publish keeps the previous data when it fails."""
